"""Documents to training files: five stages, each on all that its predecessor kept.

Every stage but the last returns the columns of `documents`. Decisions are joined by a number of each row: its id where all ids are there and differ, else one
given to the stored rows, so null and repeated ids are judged and filtered like any other. Null and empty texts, very long ones and columns of other names go
through as each operator says; an empty table gives an empty table.

A stage's scratch is deleted when another stage is called on rows that do not come from it, so the table of a stage has to be written by then, as `run` does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import for_workers
from llm.decontaminate import benchmark_hits
from llm.mixing import mixed_rows
from llm.ngram_jaccard import ngram_jaccard_components
from llm.quality import score_quality
from llm.token_files import token_index, write_token_files
from meterflow.session import delete, materialize, recorded_scratch, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch that is still there, and the stage that left it.
_LEFT: dict[str, str] = {}


def _clear(spark: SparkSession, docs: DataFrame, stage: str) -> None:
    """Delete what other stages left, but for what `docs` has yet to read."""
    for_workers(spark)
    read = docs.inputFiles() if _LEFT else []
    for path in [p for p, by in _LEFT.items() if by != stage and not any(p.rsplit("/", 1)[-1] in f for f in read)]:
        delete(spark, path)
        del _LEFT[path]


def _staged(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(spark, docs, stage.__name__)
        with recorded_scratch() as paths:
            out = stage(spark, docs, sf_dir)
        _LEFT.update(dict.fromkeys(paths, stage.__name__))
        return out

    return run


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column that numbers its rows, and the name of that column."""
    row = "_row"
    while row in (c.lower() for c in docs.columns):
        row = f"_{row}"
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if odd.isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long")), row
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """The rows of `docs` whose numbers are not in `gone`, which is stored first so that its size decides how they are joined."""
    gone = materialize(gone.toDF(row).distinct(), "gone")
    return docs.join(gone, row, "left_anti").drop(row)


@_staged
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects go. A null or empty text is judged as an empty one; of a repeated row all copies stay or go."""
    rows, row = _numbered(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(rows, row, score_quality(rows, labels, row_col=row).where("predicted = 0").select("row"))


@_staged
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows stays: that with the smallest id, null ids last. Texts without words are linked with nothing; repeated rows are copies."""
    rows, row = _numbered(docs)
    groups = ngram_jaccard_components(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    linked = groups.where(F.col(row) != F.col("component_id")).select("component_id").distinct()
    groups = groups.join(linked, "component_id").join(rows.select(row, "doc_id"), row)
    members = materialize(groups, "members")
    kept = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")).select(F.col(f"first.{row}").alias(row))
    return _without(rows, row, members.select(row).join(kept, row, "left_anti"))


@_staged
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go. Null and empty texts hold none; a repeated row is found as often as it stands."""
    rows, row = _numbered(docs)
    return _without(rows, row, benchmark_hits(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row).select("doc_id"))


@_staged
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row for each epoch, texts cut down to the words taken. Rows without a word, null texts among them, are not taken."""
    return mixed_rows(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and their index read back from them: a record for each row, null ids first, a null text as an empty one.

    The files are what the pipeline is for: they stay until the application ends.
    """
    _clear(spark, docs, "token_files")
    return token_index(write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
    ("token files", token_files),
]
#: SQL can't express the classifier, the search or the tokenizer: the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
