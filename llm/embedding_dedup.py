"""Embeddings with a cosine of at least a threshold: rotated binary codes, unbiased estimates, exact recomputation.

1. Equal vectors become one row with a count.
2. A row is turned by several random rotations. The signs are its binary code, and for each rotation the inner product of
   the code with the turned vector is stored: dividing by this correction factor makes the code's inner product with any other turned
   vector an unbiased estimate of the true one, with an error of known scale (Gao and Long, 2024).
3. Rows meet in buckets by runs of code bits. Bits and bands follow from the number of rows, the threshold and the recall
   wanted at the threshold itself; closer pairs are found more surely. A bucket of more than `BLOCK` rows is dealt out in pairs of blocks, so no
   task holds a whole large bucket.
4. In a bucket, a pair whose estimate plus its confidence bound stays below the threshold is dropped, every other pair is
   recomputed exactly. A pair counts in the first bucket that it shares only. A task returns link counts and one edge for each row, never pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.graph import components
from llm.groups import in_blocks, smallest_linked, whole_groups
from meterflow.session import materialize

BLOCK = 512
#: Bounds hold for all but about one in 30,000 estimates, and only pairs close to the threshold could be missed.
SIGMAS = 4.0


def rotations(dim: int, count: int, seed: int) -> np.ndarray:
    """`count` random rotations side by side: (dim, count * dim)."""
    made = np.random.Generator(np.random.PCG64([seed, dim]))
    return np.hstack([np.linalg.qr(made.standard_normal((dim, dim)))[0] for _ in range(count)])


def matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, digest, vec): the vector as bytes; without any of them where a vector can't be compared."""
    for batch in batches:
        out = []
        for ident, vec in zip(batch.column("vec_id").to_pylist(), batch.column("vec")):
            x = None
            if vec.is_valid and vec.values.null_count == 0:
                x = vec.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    x = None
            if x is not None:
                # Scaled by a power of two first, so that the norm of very small or large numbers stays a number; both leave the cosine as it is.
                x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
            out.append((ident, 0, None, None) if x is None else (ident, len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest(), x.tobytes()))
        columns = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["vec_id", "dim", "digest", "vec"])


class Plan:
    """Bits per band and bands, so that a pair at the threshold meets with probability `recall` at least."""

    def __init__(self, rows: int, threshold: float, recall: float):
        self.threshold = threshold
        same = 1 - math.acos(threshold) / math.pi
        self.bits = min(30, max(8, round(math.log2(max(rows, 1))) - 4))
        self.bands = math.ceil(math.log(1 - recall) / math.log1p(-(same**self.bits)))

    def turns(self, dim: int) -> int:
        return -(-self.bits * self.bands // dim)

    def keys(self, signs: np.ndarray) -> np.ndarray:
        """The bucket of each row in each band, from its code."""
        bits = signs[:, : self.bits * self.bands].reshape(len(signs), self.bands, self.bits)
        return (bits * (1 << np.arange(self.bits, dtype=np.int64))).sum(axis=2)


def _units(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _encode(plan: Plan, seed: int):
    """One row for each band: the bucket, and the code that decided it; codes are made once, here, so all bands agree on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                dims = piece.column("dim").to_numpy(zero_copy_only=False)
                for dim in np.unique(dims):
                    rows = piece.take(pa.array(np.flatnonzero(dims == dim)))
                    dim = int(dim)
                    if dim not in turns:
                        turns[dim] = rotations(dim, plan.turns(dim), seed)
                    signs = _units(rows.column("vec").to_pylist(), dim) @ turns[dim] >= 0
                    keys = plan.keys(signs)
                    codes = np.packbits(signs, axis=1)
                    n = rows.num_rows
                    which = np.tile(np.arange(n), plan.bands)
                    spread = rows.take(pa.array(which))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(spread.column(c) for c in ("row", "copies", "dim", "vec")),
                            pa.array([c.tobytes() for c in codes], pa.binary()).take(pa.array(which)),
                            pa.array(np.repeat(np.arange(plan.bands, dtype=np.int32), n)),
                            pa.array(keys.T.ravel()),
                        ],
                        names=["row", "copies", "dim", "vec", "code", "band", "key"],
                    )

    return run


class _Bucket:
    """Links inside one group of rows, by estimate first and exactly where the bound leaves it open."""

    def __init__(self, plan: Plan, seed: int):
        self.plan, self.seed, self.turns = plan, seed, {}

    def prepare(self, dim: int, raw: list[bytes], codes: list[bytes]):
        if dim not in self.turns:
            self.turns[dim] = rotations(dim, self.plan.turns(dim), self.seed)
        count = self.plan.turns(dim)
        x = _units(raw, dim)
        turned = (x @ self.turns[dim]).astype(np.float32)
        packed = np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(len(x), -1)
        signs = np.unpackbits(packed, axis=1)[:, : dim * count]
        sides = (signs.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))
        factors = np.einsum("nkd,nkd->nk", turned.reshape(-1, count, dim), sides.reshape(-1, count, dim)).clip(1e-6)
        corrected = (sides.reshape(-1, count, dim) / factors[:, :, None] / count).reshape(len(x), -1)
        spread = np.sqrt(((1 - factors**2).clip(0) / factors**2).sum(axis=1)) / count / math.sqrt(max(1, dim - 1))
        return x, turned, corrected, SIGMAS * spread, self.plan.keys(signs)

    def links(self, band: int, x, turned, corrected, error, keys, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked (i, j), i from left and j from right, or i < j where both are the same rows."""
        upper = turned[left] @ corrected[right].T + error[right]
        near = upper >= self.plan.threshold - 1e-3
        if left is right:
            near &= np.tri(len(left), k=-1, dtype=bool).T
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        first = ~(keys[i, :band] == keys[j, :band]).any(axis=1)
        i, j = i[first], j[first]
        exact = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", x[i[k : k + 65536]], x[j[k : k + 65536]]) for k in range(0, len(i), 65536))])
        return i[exact >= self.plan.threshold], j[exact >= self.plan.threshold]


def _compare(plan: Plan, seed: int):
    schema = pa.schema([("row", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Bucket(plan, seed)
        for table in whole_groups(batches):
            table = table.combine_chunks()
            ids, copies = table.column("row").to_numpy(), table.column("copies").to_numpy()
            group, band, dims = (table.column(c).to_numpy(zero_copy_only=False) for c in ("group", "band", "dim"))
            block, two = table.column("block").to_numpy(), table.column("two").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            many = [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1]
            found: list[tuple] = []
            for dim in np.unique(dims):
                own = [(a, b) for a, b in many if dims[a] == dim]
                for k in range(0, len(own), 256):
                    some = own[k : k + 256]
                    at = np.concatenate([np.arange(a, b) for a, b in some])
                    rows = table.take(pa.array(at))
                    ready = bucket.prepare(int(dim), rows.column("vec").to_pylist(), rows.column("code").to_pylist())
                    begin = 0
                    for a, b in some:
                        here = np.arange(begin, begin + b - a)
                        begin += b - a
                        if two[a]:
                            side = block[a:b] == block[a:b].min()
                            i, j = bucket.links(int(band[a]), *ready, here[side], here[~side])
                        else:
                            i, j = bucket.links(int(band[a]), *ready, here, here)
                        if len(i):
                            found.append((at[i], at[j]))
            if found:
                i, j = (np.concatenate(x) for x in zip(*found))
                names, place = np.unique(ids, return_inverse=True)
                i_of, j_of = place[i], place[j]
                links = np.zeros(len(names), dtype=np.int64)
                np.add.at(links, i_of, copies[j])
                np.add.at(links, j_of, copies[i])
                root = names[smallest_linked(len(names), i_of, j_of)]
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(names[hit]), pa.array(links[hit]), pa.array(root[hit])], schema=schema)

    return run


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, recall: float = 0.97, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    A vector that is null, empty, zero, or holds a null or non-finite component links with nothing, and so do vectors of different
    lengths. Rows without an id are left out; of rows that repeat an id, the one with the smallest length and digest counts, one that links with nothing only where all are such. An empty table gives an empty
    result. Only the two named columns are read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).where("vec_id is not null")
    rows = rows.mapInArrow(_fingerprints, "vec_id long, dim int, digest binary, vec binary")
    rows = materialize(rows, "vectors")
    known = rows.select("vec_id", "dim", "digest").groupBy("vec_id").agg(F.min(F.struct((F.col("dim") == 0).alias("none"), "dim", "digest")).alias("s")).select("vec_id", "s.*").drop("none")
    known = materialize(known, "known")
    classes = known.where("dim > 0").groupBy("dim", "digest").agg(F.min("vec_id").alias("row"), F.count("*").alias("copies"))
    vecs = classes.join(rows.where("dim > 0").select("vec_id", "dim", "digest", "vec").withColumnRenamed("vec_id", "row"), ["row", "dim", "digest"]).dropDuplicates(["row"])
    vecs = materialize(vecs, "classes")
    plan = Plan(vecs.count(), threshold, recall)
    coded = vecs.select("row", "copies", "dim", "vec").mapInArrow(_encode(plan, seed), "row long, copies long, dim int, vec binary, code binary, band int, key long")
    coded = materialize(coded, "codes")
    large = coded.groupBy("dim", "band", "key").agg(F.count("*").alias("n")).where(f"n > {BLOCK}").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    dealt = coded.join(large.drop("n"), ["dim", "band", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = in_blocks(dealt, "row", ["dim", "band", "key"], seed).select("row", "copies", "dim", "vec", "code", "band", "block", "two", "group")
    dealt = dealt.repartition(F.col("group")).sortWithinPartitions("group")
    found = materialize(dealt.mapInArrow(_compare(plan, seed), "row long, links long, root long"), "links")
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    whole = components(found.select("row", "root"), "row", "root").withColumnRenamed("node", "row")
    named = classes.join(links, "row", "left").join(whole, "row", "left").select(
        "dim", "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "row").alias("component_id")
    )
    out = known.join(named, ["dim", "digest"], "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )
