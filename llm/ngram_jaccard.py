"""Documents whose sets of five-word shingles overlap: a blocked sparse matrix product with size bounds.

The incidence matrix has a row for each different set and a column for each shingle. Multiplying it with its
transpose counts every pair's common shingles; size bounds keep almost all of that product from being made:

1. One pass over the texts gives each document its set size, a 128-bit fingerprint of the set and a few MinHash
   keys. The same pass counts the documents of every shingle, in blocks of the shingle range.
2. Equal sets become one row. Rows that share a MinHash key are compared with the smallest of them only; exact
   matches give first components, so that a large group of near copies costs a star and not all its pairs.
3. Columns are ordered: those of few documents first, frequent ones last, by hash inside both. Two sets of
   Jaccard similarity t share a column among the first n - ceil(t n) + 1 of the larger and the first
   n - ceil(2 t n / (1 + t)) + 1 of the smaller one. Only these entries, and only columns that meet two different
   components, are multiplied; counts add up over columns, and what the sizes and the positions of the last
   common entry still allow discards pairs.
4. The remaining pairs are compared exactly. With the pairs of step 2 their components are the result, and no
   link is lost: two linked sets are in one component after step 2 or they come through step 3.

The order of columns changes the cost alone. The frequent columns are broadcast, `HOT_BOUND` of them at most: where
there are more, the count from which a column is frequent doubles until they fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.graph import components
from meterflow.session import materialize

U64 = np.uint64
BANDS, ROWS = 6, 4
HOT_FROM, HOT_BOUND = 64, 1 << 20
#: Shingles that a task gathers before it sends their counts on.
FLUSH = 2_000_000
_KEY_BITS = 48
BITMAP_BITS = 1 << 24

_DOC = "doc_id long, n int, sig_a long, sig_b long, keys array<long>"
_FIRST = "block int, kind int, blob binary"
_STATS = f"kind int, shingle long, df long, {_DOC}"


def minhash(values: np.ndarray, begin: np.ndarray, count: int, seed: int = 0) -> np.ndarray:
    """`count` MinHash values of each group of hashes; an empty group has the largest value everywhere."""
    out = np.full((len(begin) - 1, count), np.iinfo(np.uint64).max, dtype=U64)
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        multipliers = T.mix(np.arange(1, count + 1, dtype=U64) + U64(seed << 16)) | U64(1)
        for k, m in enumerate(multipliers):
            out[full, k] = np.minimum.reduceat(values * m + (m >> U64(7)), begin[full])
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of consecutive signature values."""
    out = np.zeros((len(signature), bands), dtype=U64)
    for r in range(rows):
        out = T.mix(out * U64(0x9E3779B97F4A7C15) + signature[:, r : bands * rows : rows])
    return out


def fingerprints(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over scrambled members, equal for equal sets."""
    total = np.zeros((2, len(values) + 1), dtype=U64)
    np.cumsum(T.mix(values ^ U64(0xA5A5A5A55A5A5A5A)), out=total[0, 1:])
    np.cumsum(T.mix(values + U64(0x0123456789ABCDEF)), out=total[1, 1:])
    return tuple((total[:, begin[1:]] - total[:, begin[:-1]]).view(np.int64))


def _pack(keys: np.ndarray) -> bytes:
    """Sorted different keys and their counts, small: differences byte by byte, then entropy coded."""
    keys, counts = np.unique(keys, return_counts=True)
    steps = np.diff(keys, prepend=U64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T[:6].tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(10, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :6] = planes[:6].T
    return np.cumsum(steps.view("<u8").ravel(), dtype=U64), np.ascontiguousarray(planes[6:].T).view("<u4").ravel().astype(np.int64)


def _column_key(values: np.ndarray) -> np.ndarray:
    return values >> U64(64 - _KEY_BITS)


def _first_pass(blocks: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            held.clear()
            cuts = np.searchsorted(keys, (np.arange(1, blocks, dtype=U64) * U64((1 << _KEY_BITS) // blocks)))
            parts = [(k, _pack(x)) for k, x in enumerate(np.split(keys, cuts)) if len(x)]
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in parts], pa.int32()), pa.array([0] * len(parts), pa.int32()), pa.array([x for _, x in parts], pa.binary())],
                names=["block", "kind", "blob"],
            )

        for batch in batches:
            for piece in T.pieces(batch, "text"):
                values, begin = T.shingle_sets(piece.column("text"), words)
                sig_a, sig_b = fingerprints(values, begin)
                keys = band_keys(minhash(values, begin, BANDS * ROWS), BANDS, ROWS).view(np.int64)
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
                rows = np.column_stack([ids, np.diff(begin), sig_a, sig_b, keys]).astype("<i8")
                where = (T.mix(ids.astype(U64)) % U64(blocks)).astype(np.int32)
                order = np.argsort(where, kind="stable")
                cuts = np.flatnonzero(np.diff(where[order])) + 1
                parts = [x for x in np.split(order, cuts) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([where[x[0]] for x in parts], pa.int32()), pa.array([1] * len(parts), pa.int32()), pa.array([rows[x].tobytes() for x in parts], pa.binary())],
                    names=["block", "kind", "blob"],
                )
                held.append(_column_key(values))
                if sum(map(len, held)) >= FLUSH:
                    yield counted()
        if sum(map(len, held)):
            yield counted()

    return run


def _gather(group: pa.Table) -> pa.Table:
    """What the blobs of one block hold: its frequent columns (kind 0) and its documents (kind 1)."""
    kind = group.column("kind").to_numpy()
    blobs = group.column("blob").to_pylist()
    rows = np.frombuffer(b"".join(x for x, k in zip(blobs, kind) if k == 1), "<i8").reshape(-1, 4 + BANDS)
    parts = [_unpack(x) for x, k in zip(blobs, kind) if k == 0]
    keys = np.concatenate([np.zeros(0, U64), *(k for k, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    df = np.add.reduceat(counts, at) if len(at) else counts
    hot = df >= HOT_FROM
    none = lambda n, kind=pa.int64(): pa.nulls(n, kind)
    h, r = int(hot.sum()), len(rows)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(r + 1, dtype=np.int32) * BANDS), pa.array(rows[:, 4:].ravel()))
    columns = [
        (pa.array([0] * h + [1] * r, pa.int32()),),
        (pa.array(keys[at][hot].view(np.int64)), none(r)),
        (pa.array(df[hot]), none(r)),
        (none(h), pa.array(rows[:, 0])),
        (none(h, pa.int32()), pa.array(rows[:, 1].astype(np.int32))),
        (none(h), pa.array(rows[:, 2])),
        (none(h), pa.array(rows[:, 3])),
        (none(h, pa.list_(pa.int64())), lists),
    ]
    return pa.table([pa.chunked_array(list(c)) for c in columns], names=["kind", "shingle", "df", "doc_id", "n", "sig_a", "sig_b", "keys"])


def _frequent(stats: DataFrame) -> np.ndarray:
    """Keys of the columns that come last, ascending; never more than HOT_BOUND."""
    found = stats.where("kind = 0")
    by_level = {r[0]: r[1] for r in found.groupBy(F.floor(F.log2("df")).cast("int")).count().collect()}
    level = int(np.log2(HOT_FROM))
    while sum(n for k, n in by_level.items() if k >= level) > HOT_BOUND:
        level += 1
    rows = found.where(F.col("df") >= 1 << level).select("shingle").toPandas()
    return np.sort(rows.shingle.to_numpy(np.int64).view(U64))


def _prefixes(hot, words: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = hot.value
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                values, begin = T.shingle_sets(piece.column("text"), words)
                n = np.diff(begin)
                owner = np.repeat(np.arange(len(n)), n)
                key = _column_key(values)
                at = np.searchsorted(late, key)
                last = np.zeros(len(values), dtype=bool)
                inside = at < len(late)
                last[inside] = late[at[inside]] == key[inside]
                # Ascending inside a document already, so a stable sort on the flag alone gives the order of columns.
                order = np.argsort(owner * 2 + last, kind="stable")
                keep = np.where(n > 0, n - (least * n + 99) // 100 + 1, 0)
                rank = np.arange(len(values)) - begin[owner]
                chosen = values[order][rank < keep[owner]]
                ends = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)
                sig_a, _ = fingerprints(values, begin)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(sig_a), pa.ListArray.from_arrays(pa.array(ends), pa.array(chosen.view(np.int64)))],
                    names=["doc_id", "sig_a", "columns"],
                )

    return run


def _signed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                sig_a, _ = fingerprints(*T.shingle_sets(piece.column("text"), words))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sig_a), piece.column("text").cast(pa.string())], names=["doc_id", "sig_a", "text"])

    return run


def _overlaps(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch, "text_a"):
                a, at_a = T.shingle_sets(piece.column("text_a"), words)
                common = []
                for k, b_text in enumerate(piece.column("text_b")):
                    b, _ = T.shingle_sets(pa.array([b_text.as_py()]), words)
                    common.append(len(np.intersect1d(a[at_a[k] : at_a[k + 1]], b, assume_unique=True)))
                yield pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b"), pa.array(common, pa.int64())], names=["a", "b", "common"])

    return run


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `docs` that may be in `ids`: a bitmap of BITMAP_BITS bits (2 MB whatever the input) saves the shuffle of most others."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS))
    bits = (
        ids.select(place("doc_id").alias("p"))
        .groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    )
    p = place("doc_id")
    return (
        docs.withColumn("p", p)
        .withColumn("bucket", F.expr("bitmap_bucket_number(p)"))
        .withColumn("spot", F.expr("bitmap_bit_position(p)"))
        .join(F.broadcast(materialize(bits, "bitmap")), "bucket")
        .where("getbit(cast(conv(hex(substring(bits, cast(spot div 8 as int) + 1, 1)), 16, 10) as int), cast(spot % 8 as int)) = 1")
        .select(*docs.columns)
    )


def _linked(docs: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, least: int) -> DataFrame:
    """The pairs (a, b) whose similarity is at least `least` hundredths, by comparing whole sets."""
    pairs = materialize(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    ids = materialize(ids.join(sets.select("doc_id", "sig_a", "n"), "doc_id"), "ids")
    texts = _among(docs, ids).mapInArrow(_signed(words), "doc_id long, sig_a long, text string").dropDuplicates(["doc_id", "sig_a"])
    texts = materialize(texts.join(ids, ["doc_id", "sig_a"]).select("doc_id", "n", "text"), "texts")
    side = lambda k: texts.select(F.col("doc_id").alias(k), F.col("n").alias(f"n_{k}"), F.col("text").alias(f"text_{k}"))
    compared = pairs.join(side("b"), "b").join(side("a"), "a")
    common = compared.select("a", "b", "text_a", "text_b").mapInArrow(_overlaps(words), "a long, b long, common long")
    sizes = texts.select("doc_id", "n")
    return (
        common.join(sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a")), "a")
        .join(sizes.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b")), "b")
        .where(F.col("common") * 100 >= least * (F.col("n_a") + F.col("n_b") - F.col("common")))
        .select("a", "b")
    )


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = T.WORDS, least: int = 80) -> DataFrame:
    """(doc_id, n_shingles, copy_of, component_id) of every document.

    `copy_of` is the smallest id with the same set, `component_id` the smallest id reachable by links between sets
    with a similarity of at least `least` hundredths. A null or empty text has an empty set, which is linked with nothing
    and is its own copy. Rows without an id are left out. Of rows that repeat an id, the one with the smallest
    set size and fingerprint counts, an empty one only where all are empty. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stats = materialize(docs.mapInArrow(_first_pass(blocks, words), _FIRST).groupBy("block").applyInArrow(_gather, _STATS), "stats")
    known = stats.where("kind = 1").groupBy("doc_id").agg(F.min(F.struct((F.col("n") == 0).alias("empty"), "n", "sig_a", "sig_b", "keys")).alias("s")).select("doc_id", "s.*").drop("empty")
    # Equal sets: one row of the matrix.
    rows = known.where("n > 0").groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("row"), F.min("keys").alias("keys"))
    rows = materialize(rows, "rows")
    sets = rows.select(F.col("row").alias("doc_id"), "n", "sig_a")
    entries = rows.select("row", F.posexplode("keys").alias("band", "key"))
    heads = entries.groupBy("band", "key").agg(F.min("row").alias("a"), F.count("*").alias("m")).where("m > 1").drop("m")
    stars = entries.join(heads, ["band", "key"]).where("row > a").select("a", F.col("row").alias("b")).distinct()
    sizes = sets.select("doc_id", "n")
    fits = f"least(n_a, n_b) * 100L >= {least} * greatest(n_a, n_b)"
    stars = (
        stars.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b").where(fits).select("a", "b")
    )
    near = materialize(_linked(docs, sets, stars, words, least), "near")
    early = components(near, "a", "b")
    # The product of the leading columns, across components only.
    hot = spark.sparkContext.broadcast(_frequent(stats))
    prefix = docs.mapInArrow(_prefixes(hot, words, least), "doc_id long, sig_a long, columns array<long>")
    labelled = sets.join(early.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    prefix = materialize(prefix.join(labelled, ["doc_id", "sig_a"]).dropDuplicates(["doc_id"]).drop("sig_a"), "prefix")
    cells = prefix.select("doc_id", "n", "component", F.posexplode("columns").alias("pos", "h"))
    columns = cells.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("h")
    live = materialize(cells.join(columns, "h"), "live")
    # ceil(2 t n / (1 + t)) leading entries of the smaller side are enough.
    a = live.where(f"pos < n - ceil(2 * {least} * n / ({100 + least})) + 1")
    a = a.select("h", *[F.col(c).alias(f"{c}_a") for c in ("doc_id", "n", "component", "pos")])
    b = live.select("h", *[F.col(c).alias(f"{c}_b") for c in ("doc_id", "n", "component", "pos")])
    needed = f"ceil({least} * (n_a + n_b) / {100 + least})"
    pairs = (
        a.join(b, "h")
        .where("component_a <> component_b and (n_a < n_b or (n_a = n_b and doc_id_a < doc_id_b))")
        .where(f"n_a * 100L >= {least} * n_b and least(n_a - pos_a, n_b - pos_b) >= {needed} - least(pos_a, pos_b)")
        .groupBy("doc_id_a", "doc_id_b", "n_a", "n_b")
        .agg(F.count("*").alias("seen"), F.max("pos_a").alias("pos_a"), F.max("pos_b").alias("pos_b"))
        .where(f"seen + least(n_a - pos_a, n_b - pos_b) - 1 >= {needed}")
        .select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
    )
    across = _linked(docs, sets, pairs, words, least)
    whole = components(near.unionByName(across), "a", "b")
    named = rows.join(whole.withColumnRenamed("node", "row"), "row", "left").select("n", "sig_a", "sig_b", "row", F.coalesce("component", "row").alias("component"))
    return known.join(named, ["n", "sig_a", "sig_b"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("row", "doc_id").alias("copy_of"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
