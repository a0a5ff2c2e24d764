"""Hard negatives by integer inner products, found with Fagin's threshold algorithm over sorted component lists.

1. Vectors become integers. Rows are dealt into groups of bounded size, and every group gets, for each component, its rows sorted by that
   component. Anchors stream past the groups: a task holds one group and one batch of anchors.
2. For an anchor a list is read from the end that its component's sign asks for, all lists to the same depth. Rows met in any list are scored
   whole. What no list has shown yet can score at most the sum of the anchor's components times the values the lists have got to: once this threshold falls strictly
   below the k-th best score of every window, the group has nothing more to give. Strictly, since an unseen row may tie with a smaller id.
3. The first pass looks for the nearest rows of the anchor's own label, in groups of that label; the second for rows of
   other labels inside the window of scores that each of those positives sets. The best k of all groups are ranked at the end.

Depths double, and the rows that lists show up to a depth are kept as bits, for each component and end, so that reading all lists is an `or` over a few kilobytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.session import materialize

#: A group has at most about this many components (64 k rows of 64), and so many rows at least where there are enough.
CELLS, LEAST_ROWS = 1 << 22, 1 << 11
#: Tables too small to fill more groups than this have smaller groups, so that the work spreads.
GROUPS = 32
_FIRST_DEPTH = 16
_ROW, _ANCHOR = 0, 1
_FOUND = "anchor long, window int, other_id long, score long"
_FOUND_TYPES = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])


class Lists:
    """The rows of one group, by ascending id, with the sorted list of each component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], np.ascontiguousarray(x[order])
        n, dim = self.x.shape
        self.norm = float(np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        self.narrow = {np.dtype(np.int64): self.x}
        listed = np.argsort(self.x, axis=0, kind="stable")
        self.depths = sorted({min(n, _FIRST_DEPTH << k) for k in range(max(n, 1).bit_length())})
        # shown[depth, end, component] are the rows of the list's first `depth` entries, from the largest (end 0) or the smallest value on.
        self.shown = np.zeros((len(self.depths), 2, dim, -(-n // 8)), dtype=np.uint8)
        self.reached = np.zeros((len(self.depths), 2, dim), dtype=np.int64)
        components = np.arange(dim)
        for end, entries in enumerate((listed[::-1], listed)):
            bits = np.zeros((dim, n), dtype=bool)
            done = 0
            for k, depth in enumerate(self.depths):
                bits[components[None, :], entries[done:depth]] = True
                self.shown[k, end] = np.packbits(bits, axis=1)
                self.reached[k, end] = self.x[entries[depth - 1], components]
                done = depth

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products: as floats where every partial sum fits in them (Cauchy-Schwarz), else as integers."""
        bound = self.norm * float(np.linalg.norm(q.astype(np.float64)))
        kind = np.dtype(np.float32 if bound < 1 << 23 else np.float64 if bound < 1 << 52 else np.int64)
        if kind not in self.narrow:
            self.narrow[kind] = self.x.astype(kind)
        return (self.narrow[kind][rows] @ q.astype(kind)).astype(np.int64)

    def thresholds(self, q: np.ndarray) -> list[int]:
        """For each depth, the most that a row can score which no list has shown."""
        reached = np.where(q > 0, self.reached[:, 0], self.reached[:, 1])
        if int(np.abs(q).max()) * int(np.abs(reached).max()) * len(q) < 1 << 62:
            return (reached @ q).tolist()
        return [sum(a * b for a, b in zip(q.tolist(), r.tolist())) for r in reached]

    def search(self, ident: int, label: int, same: bool, q: np.ndarray, windows: list[tuple], k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """(ids, scores) of the best k rows in each window (lowest, highest score; None is open), and how many rows were scored.

        Only rows of the same label (other ids) or of other labels count. Ties go to the smaller id.
        """
        asked = [w for w in windows if None in w or w[0] <= w[1]]
        if not asked:
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows], 0
        use = np.flatnonzero(q)
        ends = (q[use] < 0).astype(np.int64)
        limits = self.thresholds(q)
        tops = [high for _, high in asked]
        # While the threshold is not below a window's highest score, no k-th score can be above it.
        start = 0 if None in tops else next((d for d, limit in enumerate(limits) if limit < min(tops)), len(limits) - 1)
        scored = np.zeros(self.shown.shape[-1], dtype=np.uint8)
        rows, points, met = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for depth in range(start, len(limits)):
            last = depth == len(limits) - 1
            # A vector of zeros has no list to read; all rows score 0.
            seen = np.bitwise_or.reduce(self.shown[depth, ends, use], axis=0) if len(use) else self.shown[-1, 0, 0]
            new = np.flatnonzero(np.unpackbits(seen & ~scored, count=len(self.ids)))
            scored = seen
            met += len(new)
            new = new[(self.labels[new] == label) & (self.ids[new] != ident) if same else self.labels[new] != label]
            rows, points = np.concatenate([rows, new]), np.concatenate([points, self.scores(new, q)])
            if last or all(self._closed(points, limits[depth], window, k) for window in asked):
                break
        return [self._best(rows, points, window, k) for window in windows], met

    @staticmethod
    def _inside(points: np.ndarray, window: tuple) -> np.ndarray:
        low, high = window
        inside = np.ones(len(points), dtype=bool) if low is None else points >= low
        return inside if high is None else inside & (points <= high)

    def _closed(self, points: np.ndarray, limit: int, window: tuple, k: int) -> bool:
        if window[0] is not None and limit < window[0]:
            return True
        own = points[self._inside(points, window)]
        return len(own) >= k and limit < int(np.partition(own, len(own) - k)[len(own) - k])

    def _best(self, rows: np.ndarray, points: np.ndarray, window: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self._inside(points, window))
        if len(at) > k:
            at = at[points[at] >= np.partition(points[at], len(at) - k)[len(at) - k]]
        # Rows are in order of their ids.
        at = at[np.lexsort((rows[at], -points[at]))[:k]]
        return self.ids[rows[at]], points[at]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def _search(k: int, same: bool, percent: tuple[int, int] | None):
    """Rows of a group come before its anchors: the first are kept with their lists, the others pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, lists = None, [], None
        for batch in batches:
            keys, kinds = batch.column("group").to_numpy(zero_copy_only=False), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = batch.slice(a, b - a)
                if keys[a] != now:
                    now, held, lists = keys[a], [], None
                if kinds[a] == _ROW:
                    held.append(part.select(["id", "label", "x"]))
                    continue
                if not held and lists is None:
                    continue
                if lists is None:
                    table = pa.Table.from_batches(held)
                    lists, held = Lists(table.column("id").to_numpy(), table.column("label").to_numpy(), _matrix(table.column("x"), table.num_rows)), []
                yield from _answers(part, lists, k, same, percent)

    return run


def _answers(anchors: pa.RecordBatch, lists: Lists, k: int, same: bool, percent: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    ids, labels, numbers = (anchors.column(c).to_pylist() for c in ("id", "label", "anchor"))
    levels = anchors.column("levels").to_pylist()
    found: list[tuple] = []
    for row, q in enumerate(_matrix(anchors.column("x"), anchors.num_rows)):
        windows = [(None, None)] if percent is None else [(-(-percent[0] * level // 100), percent[1] * level // 100) for level in levels[row]]
        best, _ = lists.search(ids[row], labels[row], same, q, windows, k)
        found.extend((numbers[row], w, i, s) for w, (own, scores) in enumerate(best) for i, s in zip(own.tolist(), scores.tolist()))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _FOUND_TYPES.types)], schema=_FOUND_TYPES)


def _dealt(rows: DataFrame, anchors: DataFrame, by: list[str]) -> DataFrame:
    """Rows and anchors that agree in `by`, in tiles of bounded size: every row meets every such anchor in one `group`."""
    most = F.greatest(F.lit(1), (F.lit(CELLS) / F.col("dim")).cast("long"))
    each = F.least(most, F.greatest(F.lit(LEAST_ROWS), (F.col("rows") / GROUPS).cast("long")))
    sizes = rows.groupBy(*by).agg(F.count("*").alias("rows")).join(anchors.groupBy(*by).agg(F.count("*").alias("anchors")), by)
    sizes = sizes.select(*by, F.ceil(F.col("rows") / each).alias("across"), F.ceil(F.col("anchors") / most).alias("down"))
    # Stored, so that its size decides how it is joined.
    sizes = materialize(sizes, "tiles")
    groups = sizes.agg(F.sum(F.col("across") * F.col("down"))).first()[0] or 1
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    bucket = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    left = rows.join(sizes, by).withColumn("i", bucket("across")).withColumn("j", every("down")).withColumn("kind", F.lit(_ROW)).withColumn("levels", F.lit(None).cast("array<long>"))
    right = anchors.join(sizes, by).withColumn("i", every("across")).withColumn("j", bucket("down")).withColumn("kind", F.lit(_ANCHOR))
    columns = [F.concat_ws(":", *by, "i", "j").alias("group"), "kind", F.col("row").alias("anchor"), "id", "label", "x", "levels"]
    both = left.select(*columns).unionByName(right.select(*columns))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(groups, 1 << 15))
    return both.repartition(parts, "group").sortWithinPartitions("group", "kind")


def _nearest(rows: DataFrame, anchors: DataFrame, by: list[str], k: int, same: bool, percent: tuple[int, int] | None) -> DataFrame:
    """(anchor, window, other_id, score, rank): the best k of all groups for each anchor and window."""
    found = _dealt(rows, anchors, by).mapInArrow(_search(k, same, percent), _FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), a row for each negative of an anchor and positive.

    Components become floor(scale * component), a score is an integer inner product; higher scores come first, equal ones by smaller id. `anchors` is a condition
    on the columns of `vectors`. An anchor's positives are its first other rows of its label, its negatives for one of them the first rows of other labels with
    percent[0] * positive score <= 100 * score <= percent[1] * positive score; a negative positive score leaves none.

    Rows with a null id, label or vector, an empty vector, a null or non-finite component, or integers whose inner product with themselves is
    2**62 or more (so that every score fits in a long) take no part. Vectors of different lengths do not meet. Exactly repeated rows count once; rows that share an id but not
    the rest are rows of their own, and none is a positive of the other. An empty table gives an empty result. Only the three named columns and those of `anchors` are read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    # NaN compares as larger than infinity.
    rows = rows.where("id is not null and label is not null and size(v) > 0").where(F.forall("v", lambda y: y.isNotNull() & (F.abs(y) < float("inf"))))
    rows = rows.select("id", "label", "anchor", F.transform("v", lambda y: F.floor(y * scale)).alias("x")).distinct()
    square = F.aggregate("x", F.lit(0.0), lambda total, y: total + y.cast("double") * y.cast("double"))
    rows = rows.where(square < float(1 << 62)).select(F.monotonically_increasing_id().alias("row"), "*", F.size("x").alias("dim"))
    rows = materialize(rows, "integers")
    chosen = rows.where("anchor")
    near = _nearest(rows, chosen.withColumn("levels", F.lit(None).cast("array<long>")), ["dim", "label"], positives, True, None)
    near = materialize(near.select(F.col("anchor").alias("row"), (F.col("rank") - 1).alias("window"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    levels = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("window", "positive_score"))).alias("levels"))
    wanted = chosen.join(levels.withColumn("levels", F.col("levels.positive_score")), "row")
    far = _nearest(rows, wanted, ["dim"], negatives, False, percent)
    far = far.select(F.col("anchor").alias("row"), "window", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near, ["row", "window"]).join(chosen.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
