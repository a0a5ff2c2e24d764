"""Language by compression: the language whose dictionary makes a text smallest.

A language's dictionary is raw text of that language. zstandard finds a text's pieces in the dictionary it was given, so a
text comes out smaller with its own language's. Letters alone are compared, in lower case, in segments that keep the dictionary within
reach, so very long texts are judged by all their parts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_SEGMENT = 32 << 10
_BASE = {"write_checksum": 0, "write_content_size": 0, "write_dict_id": 0}
_SEARCH = {"window_log": 18, "hash_log": 15, "chain_log": 15, "search_log": 4, "min_match": 3, "target_length": 32}


def letters(text: str) -> str:
    """Runs of letters in lower case, one space around each; empty without a letter."""
    out = " " + _OTHER.sub(" ", text.lower()).strip() + " "
    return out if any(map(str.isalpha, out)) else ""


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; 0 (held out) where there is no id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(0))


def learn_dictionaries(docs: DataFrame, id_col: str, text_col: str, lang_col: str, dictionary_bytes: int = 64 << 10, sampled_docs: int = 200) -> dict[str, bytes]:
    """A raw dictionary for each language of the rows that are not held out, the language with the most rows first.

    Bounds: about `sampled_docs` documents of a language, chosen by a hash of their ids, of which `dictionary_bytes` in all
    come into its dictionary, from every document an equal share, that begins at a hashed place of its whole text. A language stays
    out only where none of its chosen documents has a letter there.
    """
    learned = docs.where(fold(id_col) != 0).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = learned.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return {}
    parts = {r["lang"]: max(64, dictionary_bytes // min(sampled_docs, r["count"])) for r in counts}
    share = docs.sparkSession.createDataFrame([Row(lang=r["lang"], share=min(1.0, sampled_docs / r["count"]), part=parts[r["lang"]]) for r in counts])
    place = F.pmod(F.xxhash64(F.lit("dictionary"), id_col), F.lit(1 << 30))
    # Twice the share in characters, as not all are letters; the last place from which so many follow is the last to begin at.
    begin = F.expr("1 + pmod(xxhash64('begin', place), greatest(1L, length(text) - 2L * part + 1))")
    sample = (
        learned.select(F.col(lang_col).alias("lang"), place.alias("place"), F.col(text_col).alias("text"))
        .join(F.broadcast(share), "lang")
        .where(F.col("place") <= F.col("share") * (1 << 30))
        .select("lang", "place", F.substring("text", begin.cast("int"), (2 * F.col("part")).cast("int")).alias("text"))
    )
    found: dict[str, list] = {r["lang"]: [] for r in counts}
    for r in sample.collect():
        found[r["lang"]].append((r["place"], letters(r["text"]).encode()[: parts[r["lang"]]]))
    out = {}
    for lang, texts in found.items():
        data = b"".join(x for _, x in sorted(texts))
        if data:
            out[lang] = data
    return out


class Identifier:
    def __init__(self, dictionaries: dict[str, bytes], reject_margin: float):
        self.langs, self.margin = list(dictionaries), reject_margin
        self.coders = []
        for data in dictionaries.values():
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters(**_SEARCH, strategy=zstandard.STRATEGY_BTLAZY2, **_BASE)
            self.coders.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=raw))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        data = letters(text or "").encode()
        if not data or not self.coders:
            return UNKNOWN, 0.0, True
        parts = [data[k : k + _SEGMENT] for k in range(0, len(data), _SEGMENT)]
        sizes = [sum(len(coder.compress(x)) for x in parts) for coder in self.coders]
        best = min(range(len(sizes)), key=sizes.__getitem__)  # of equal sizes the language with more rows
        rest = sorted(sizes)
        narrow = len(rest) > 1 and rest[1] - rest[0] < self.margin * rest[1]
        return self.langs[best], 1 / sum(math.exp((sizes[best] - x) / 2) for x in sizes), narrow


def identify_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", reject_margin: float = 0.005, dictionary_bytes: int = 64 << 10, sampled_docs: int = 200
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row, read as a whole text.

    Rows whose crc32(id as text) modulo 5 is 0 are held out; the others' texts and languages make the dictionaries. `lang_pred` is
    `und` with score 0 where the text is null or has no letter, and where nothing could be learned. `rejected` marks those and every text
    whose smallest size is less than `reject_margin` below the next. A null id is held out. Repeated rows are judged alike. Only
    the three named columns are read.
    """
    spark = docs.sparkSession
    dictionaries = spark.sparkContext.broadcast(learn_dictionaries(docs, id_col, text_col, lang_col, dictionary_bytes, sampled_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = Identifier(dictionaries.value, reject_margin)
        for batch in batches:
            found = [identify(x.as_py()) for x in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("held_out"), *(pa.array([r[k] for r in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_())))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
