"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import for_workers
from llm.chat import chat_digests, format_chat, write_chat
from llm.decontaminate import benchmark_hits
from llm.embedding_dedup import embedding_components
from llm.fill_middle import fill_middle_digests
from llm.hard_negatives import mine_hard_negatives
from llm.language import identify_language
from llm.licenses import scan_licenses
from llm.line_dedup import dedup_lines
from llm.mixing import mix_sources
from llm.ngram_jaccard import ngram_jaccard_components
from llm.quality import score_quality
from llm.token_files import token_index, write_token_files
from llm.twins import FORGED, SQL
from llm.warc import archived_pages, write_warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return for_workers(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_components(_table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_table(spark, folder, "documents"))


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    forged = spark.sql(f"select -1L as conv_id, turn, role, '{FORGED}' as text from values (0L, 'user'), (1L, 'assistant') as t(turn, role)")
    return chat_digests(write_chat(format_chat(rows.unionByName(forged))))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark_hits(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_index(write_token_files(_table(spark, folder, "documents"), TOKENIZER))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_language(_table(spark, folder, "documents"))


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(_table(spark, folder, "documents")).taken()


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(_table(spark, folder, "documents"))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_components(_table(spark, folder, "embeddings"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    ids, label = F.col("vec_id"), F.col("label")
    rows = _table(spark, folder, "embeddings").withColumn("label", F.when(ids % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine_hard_negatives(rows, ids % 50 == 0)


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived_pages(write_warc(_table(spark, folder, "pages")))


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle_digests(_table(spark, folder, "documents"))


__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_license_scan": op2_license_scan,
    "op3_chat_format": op3_chat_format,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_language_id": op7_language_id,
    "op8_source_mix": op8_source_mix,
    "op9_line_dedup": op9_line_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc": op12_warc,
    "op13_fill_middle": op13_fill_middle,
}
