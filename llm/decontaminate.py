"""Documents that hold benchmark passages, also reworded: latent semantic retrieval, then subsequence and answer checks.

1. Benchmark items are searched in blocks of `block` items. An item is one unit, a long one is cut into overlapping units. The words of a
   block's units are the features. The documents' words are read once a block and stored as numbers of features; all later steps read those.
   They count in how many passages each feature stands, which gives the weights.
2. The units and all passages of the documents are the rows of a TF-IDF matrix. Its leading right singular vectors come from a
   randomised SVD: tasks multiply their rows with a random matrix and back, partial sums are added by slices of features, and these give the
   singular values as well. The units weigh as much as all passages, so their directions are kept.
3. Every passage of every document, overlapping by half, is folded into that space and compared with all units of the block by matrix product.
4. Where a passage is close to a unit, the words around it are compared with the unit's by longest common subsequence, on stretches of
   little more than the unit's length, and so is the unit's answer. A unit is found where most of its words stand there in order, or a smaller part
   and the answer as well. Before that, arrays count for all close passages of a piece at once how many words of a stretch are the unit's at
   all, in any order, first in whole bins around it: where these are too few everywhere, no subsequence is long enough.

Nothing of a size that grows with the documents reaches the driver: features are bounded by a block, sums by features x range.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from meterflow.session import delete, materialize, scratch_path

U64 = np.uint64
HALF = 32
UNIT = 96
#: An item of fewer words is found only whole, in order and without gaps.
SHORT = 12
SLICE = 512
#: Words of a bin, and the empty bins between texts: no stretch around a passage reaches over them.
BIN = 16
GAP = 2 * (HALF + UNIT)
#: Bytes of stored words that are worked on at once.
_PIECE = 160 << 10


@dataclass(frozen=True)
class Limits:
    """When a passage is looked at closely, and when a unit counts as found."""

    cosine: float = 0.25
    share: float = 0.15
    whole: float = 0.75
    part: float = 0.5
    answer: float = 0.8
    rank: int = 128
    extra: int = 32


LIMITS = Limits()


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words, without case and punctuation, and where each text's begin."""
    raw, bounds = T.buffers(column)
    raw = T.plained(raw)
    starts, ends, first = T.words(raw, bounds)
    return T.span_hashes(raw, starts, ends), first


def answer_at(text: str) -> int:
    """How many words stand before the answer: the last sentence, or the last quarter where there is one sentence only."""
    cut = max(text.rstrip().rstrip(".!?").rfind(x) for x in (". ", ".\n", "! ", "? ", "!\n", "?\n"))
    count = lambda s: len(T.plained(np.frombuffer(s.encode(), np.uint8)).tobytes().split())
    total = count(text)
    before = count(text[: cut + 1]) if cut >= 0 else 0
    return before if 0 < before < total else total - max(1, total // 4)


@dataclass
class Units:
    """The searched units of one block: their items, words and answers by number, and the features (hashes of their words).

    A word's number is its feature's place and one; words of answers alone have the numbers after the features', any other word is 0.
    """

    items: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    features: np.ndarray
    others: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str, str | None]]) -> Units:
        items, words, answers = [], [], []
        for item, text, answer in rows:
            hashes, _ = word_hashes(pa.array([text]))
            own = word_hashes(pa.array([answer]))[0] if answer else hashes[answer_at(text) :]
            steps = [(0, len(hashes))] if len(hashes) <= UNIT else [(k, min(len(hashes), k + UNIT)) for k in range(0, len(hashes) - HALF, UNIT // 2)]
            for a, b in steps:
                if b > a:
                    items.append(item)
                    words.append(hashes[a:b])
                    # A part of a long item holds an answer of its own: its last quarter.
                    answers.append(own if len(steps) == 1 else hashes[b - (b - a) // 4 : b])
        features = np.unique(np.concatenate([np.zeros(0, U64), *words]))
        out = cls(items, [], [], features, np.setdiff1d(np.concatenate([np.zeros(0, U64), *answers]), features))
        out.words, out.answers = [out.numbers(w) for w in words], [out.numbers(a) for a in answers]
        return out

    @property
    def kind(self) -> str:
        """The stored type of a word's number."""
        return "<u2" if len(self.features) + len(self.others) < 1 << 16 else "<u4"

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), dtype=self.kind)
        for known, before in ((self.features, 1), (self.others, 1 + len(self.features))):
            if not len(known):
                continue
            table = np.zeros(1 << 16, dtype=bool)
            table[known & U64(0xFFFF)] = True
            at = np.flatnonzero(table[(hashes & U64(0xFFFF)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
            same = known[place] == hashes[at]
            out[at[same]] = place[same] + before
        return out

    def matched(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are features, and which."""
        at = np.flatnonzero((numbers > 0) & (numbers <= len(self.features)))
        return at, numbers[at].astype(np.int64) - 1


def binaries(data: np.ndarray, first: np.ndarray) -> pa.Array:
    """One binary value for each run of entries, from where the runs begin."""
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * data.itemsize).astype("<i4")), pa.py_buffer(np.ascontiguousarray(data))])


def entries(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of `binaries`."""
    raw, bounds = T.buffers(column)
    return raw.view(kind), bounds // np.dtype(kind).itemsize


def _coded(units):
    """The words of each document as numbers of the block's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = units.value
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                hashes, first = word_hashes(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), binaries(block.numbers(hashes), first)], names=["doc_id", "words"])

    return run


def halves(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half passages of each text, one at least, and where each text's begin; (begin, number of the text's first word per half)."""
    n = np.maximum(1, -(-np.diff(first) // HALF))
    return np.concatenate([[0], np.cumsum(n)]), n


def half_of(at: np.ndarray, first: np.ndarray, begin: np.ndarray) -> np.ndarray:
    text = np.searchsorted(first, at, side="right") - 1
    return begin[text] + (at - first[text]) // HALF


def passage_of(half: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The number of the passage, two halves of one text, in which each half stands; none reaches into the next text."""
    text = np.searchsorted(begin, half, side="right") - 1
    before = np.concatenate([[0], np.cumsum((np.diff(begin) + 1) // 2)])
    return before[text] + (half - begin[text]) // 2


def run_sums(table: np.ndarray, index: np.ndarray, sizes: np.ndarray, scale: np.ndarray | None = None) -> np.ndarray:
    """Sums of the rows `table[index]`, each times its scale, over runs of these sizes, one behind the other."""
    most = int(sizes.max(initial=0))
    if most > HALF:
        parts = -(-sizes // HALF)
        run = np.repeat(np.arange(len(sizes)), parts)
        cut = np.minimum(HALF, sizes[run] - HALF * (np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)))
        return run_sums(run_sums(table, index, cut, scale), np.arange(len(run)), parts)
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    out = np.zeros((len(sizes), table.shape[1]), dtype=table.dtype)
    for k in range(most):
        at = starts[: np.count_nonzero(sizes > k)] + k
        out[: len(at)] += table[index[at]] if scale is None else table[index[at]] * scale[at, None]
    sums = np.empty_like(out)
    sums[order] = out
    return sums


def _counted(units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = units.value
        total, passages = np.zeros(len(block.features), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for piece in T.pieces(batch, "words", _PIECE):
                words, first = entries(piece.column("words"), block.kind)
                begin, _ = halves(first)
                at, feature = block.matched(words)
                half = half_of(at, first, begin)
                seen = np.unique(half * len(total) + feature) % len(total)
                total += np.bincount(seen, minlength=len(total))
                passages += begin[-1], len(np.unique(passage_of(half, begin)))
        cuts = range(0, len(total), SLICE)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *(k // SLICE for k in cuts)], pa.int32()), pa.array([passages.tobytes(), *(total[k : k + SLICE].tobytes() for k in cuts)], pa.binary())],
            names=["slice", "part"],
        )

    return run


def _added(kind: str):
    def run(group: pa.Table) -> pa.Table:
        parts = group.column("part")
        out = np.frombuffer(parts[0].as_py(), kind).copy()
        for x in parts[1:]:
            out += np.frombuffer(x.as_py(), kind)
        return pa.table({"slice": group.column("slice")[:1].cast(pa.int32()), "part": pa.array([out.tobytes()], pa.binary())})

    return run


def _summed(parts: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """Sums of equal slices: added up in 16 groups of parts each first, whatever the number of tasks."""
    half = parts.withColumn("deal", F.pmod(F.spark_partition_id(), F.lit(16))).groupBy("slice", "deal").applyInArrow(_added(kind), "slice int, part binary")
    rows = half.groupBy("slice").applyInArrow(_added(kind), "slice int, part binary").collect()
    return {r["slice"]: np.frombuffer(r["part"], kind) for r in rows}


def _weights(units: Units, counts: dict[int, np.ndarray]) -> np.ndarray:
    passages = max(1, int(counts.get(-1, [0])[0]))
    df = np.concatenate([np.zeros(0, np.int64), *(counts[k] for k in sorted(counts) if k >= 0)])
    if not len(df):
        df = np.zeros(len(units.features), dtype=np.int64)
    # Never 0: an item that leaked into many documents makes its own words common.
    return np.log1p((1 + passages) / (1 + df)).astype(np.float32)


def _sparse(units, weights):
    """Rows of the matrix: for each passage with a feature, its features and their tf-idf values, scaled to length 1, and the scale of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = units.value, weights.value
        for batch in batches:
            for piece in T.pieces(batch, "words", _PIECE):
                words, first = entries(piece.column("words"), block.kind)
                begin, _ = halves(first)
                at, feature = block.matched(words)
                rows, columns, values = _scaled(passage_of(half_of(at, first, begin), begin), feature, weight)
                if not len(rows):
                    continue
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1, [len(rows)]])
                scale = np.repeat(piece.column("scale").to_numpy(), (np.diff(begin) + 1) // 2)[rows[cuts[:-1]]]
                yield pa.RecordBatch.from_arrays([binaries(columns.astype("<i4"), cuts), binaries(values.astype("<f4"), cuts), pa.array(scale)], names=["columns", "vals", "scale"])

    return run


def _scaled(row: np.ndarray, feature: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, count = np.unique(row * len(weight) + feature, return_counts=True)
    rows, columns = key // len(weight), key % len(weight)
    values = count * weight[columns]
    norm = np.sqrt(np.bincount(rows, weights=values**2)) if len(rows) else np.zeros(1)
    return rows, columns, values / norm[rows]


def _product(dense, made=None):
    """Partial sums of A' (A dense), by slices of features; `made` makes the rows of A from the batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = dense.value
        total = np.zeros(right.shape)
        for batch in made(batches) if made else batches:
            columns, begin = entries(batch.column("columns"), "<i4")
            values = entries(batch.column("vals"), "<f4")[0] * np.repeat(batch.column("scale").to_numpy(), np.diff(begin)).astype(np.float32)
            for k in range(0, batch.num_rows, 512):
                cuts = begin[k : k + 513]
                own, value = columns[cuts[0] : cuts[-1]], values[cuts[0] : cuts[-1]]
                y = run_sums(right, own, np.diff(cuts), value)
                row = np.repeat(np.arange(len(y)), np.diff(cuts))
                order = np.argsort(own, kind="stable")
                found, sizes = np.unique(own, return_counts=True)
                total[found] += run_sums(y, row[order], sizes, value[order])
        cuts = range(0, len(total), SLICE)
        yield pa.RecordBatch.from_arrays([pa.array([k // SLICE for k in cuts], pa.int32()), pa.array([total[k : k + SLICE].tobytes() for k in cuts], pa.binary())], names=["slice", "part"])

    return run


def randomised_svd(rows: DataFrame, features: int, rank: int, extra: int, seed: int = 11, made: tuple | None = None) -> np.ndarray:
    """The leading right singular vectors (features, rank) of sparse rows (columns, vals, scale), which are read once.

    With an orthonormal random matrix X, the sums Y = A' (A X) span the range and give X' Y, the part of A' A seen by X. Y (X' Y)^-1 Y' stands
    for A' A; its eigenvectors are the singular vectors of Y times the inverse root of X' Y.
    Where `rows` is `source.mapInArrow(step)`, `made` may name (source, step): then rows are made and multiplied in one worker, not in two a task.
    """
    width = min(features, rank + extra)
    start, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((features, width)))
    start = start.astype(np.float32)
    source, step = made or (rows, None)
    parts = _summed(source.mapInArrow(_product(rows.sparkSession.sparkContext.broadcast(start), step), "slice int, part binary"), "<f8")
    y = np.concatenate([parts[k] for k in sorted(parts)]).reshape(features, width) if parts else np.zeros((features, width))
    core, turn = np.linalg.eigh((start.T @ y + y.T @ start) / 2)
    # Directions that the sums in single precision cannot tell from nothing are left out.
    sure = core > 1e-5 * max(core.max(), 1e-30)
    vectors, values, _ = np.linalg.svd(y @ turn[:, sure] / np.sqrt(core[sure]), full_matrices=False)
    return vectors[:, :rank][:, values[:rank] ** 2 > 1e-9 * max(values.max(initial=0) ** 2, 1e-30)].astype(np.float32)


def subsequence(masks: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence of a unit, given as bit masks of each word's places, and `words`."""
    state = full = (1 << masks[-1]) - 1
    for w in words:
        m = masks.get(w)
        if m:
            u = state & m
            state = ((state + u) | (state - u)) & full
    return masks[-1] - state.bit_count()


def masks_of(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {-1: len(words)}
    for k, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


class Search:
    def __init__(self, units: Units, weights: np.ndarray, space: np.ndarray, limits: Limits):
        self.units, self.weights, self.space, self.limits = units, weights, space, limits
        self.masks = [masks_of(w) for w in units.words]
        self.answers = [masks_of(w) for w in units.answers]
        self.counts = [Counter(w.tolist()) for w in units.words]
        self.known = [frozenset(c) for c in self.counts]
        self.lengths = np.array([len(w) for w in units.words], dtype=np.int64)
        # Which features are words of which unit; the last column stands for all other words.
        self.member = np.zeros((len(units.words), len(units.features) + 1), dtype=bool)
        for k, w in enumerate(units.words):
            self.member[k, w - 1] = True
        self.held = np.ascontiguousarray(self.member[:, :-1].T).view(np.uint8)
        self.folded = space * weights[:, None]
        folded = np.zeros((len(units.items), space.shape[1]), dtype=np.float32)
        for k, w in enumerate(units.words):
            folded[k] = self.folded[w - 1].sum(axis=0)
        self.sizes = np.linalg.norm(folded, axis=1)
        self.targets = folded / np.maximum(self.sizes, 1e-9)[:, None]

    def near(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, unit, cosine) of the passages close to a unit, with enough of its words around them."""
        begin, n = halves(first)
        at, feature = self.units.matched(words)
        half = half_of(at, first, begin)
        sums = run_sums(self.folded, feature, np.bincount(half, minlength=int(begin[-1]) + 1))
        last = np.zeros(len(sums), dtype=bool)
        last[begin[1:] - 1] = True
        passages = sums[:-1]
        passages[~last[:-1]] += sums[1:][~last[:-1]] if len(sums) > 1 else 0
        norm = np.linalg.norm(passages, axis=1)
        found = []
        for k in range(0, len(passages), 4096):
            dots = passages[k : k + 4096] @ self.targets.T
            i, j = np.nonzero((dots >= self.limits.cosine * norm[k : k + 4096, None]) & (dots >= self.limits.share * self.sizes) & (dots > 0))
            found.append((i + k, j, dots[i, j] / norm[i + k]))
        i, j, cosine = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        text = np.searchsorted(begin, i, side="right") - 1
        place = first[text] + (i - begin[text]) * HALF
        kept = np.flatnonzero(self.possible(at, feature, first, text, place, j))
        kept = kept[self.enough(at, feature, first, text[kept], place[kept], j[kept])]
        return text[kept], place[kept], j[kept], cosine[kept]

    def possible(self, at: np.ndarray, feature: np.ndarray, first: np.ndarray, text: np.ndarray, place: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Whether the whole bins that a stretch around each passage touches have enough words of the unit: where not, `enough` is false."""
        begin = np.concatenate([[0], np.cumsum(-(-np.diff(first) // BIN) + GAP // BIN)]) + GAP // BIN
        owner = np.searchsorted(first, at, side="right") - 1
        bins = begin[owner] + (at - first[owner]) // BIN
        # Row k has the words in the bins before k.
        seen = np.cumsum(run_sums(self.held, feature, np.bincount(bins + 1, minlength=int(begin[-1]) + 1)), axis=0, dtype=np.int32).ravel()
        cell = (begin[text] + (place - first[text]) // BIN) * len(self.lengths) + unit
        kept = np.zeros(len(unit), dtype=bool)
        lengths = self.lengths[unit]
        order = np.argsort(lengths, kind="stable")
        for n in np.unique(lengths).tolist():
            least, length = n if n < SHORT else self.limits.part * n, n + max(4, n // 4)
            own = order[slice(*np.searchsorted(lengths[order], [n, n + 1]))]
            wide = ((length + BIN - 2) // BIN + 1) * len(self.lengths)
            for k in range(-n // BIN, (2 * HALF + n - length) // BIN + 1):
                low = cell[own] + k * len(self.lengths)
                kept[own] |= seen[low + wide] - seen[low] >= least
        return kept

    def enough(self, at: np.ndarray, feature: np.ndarray, first: np.ndarray, text: np.ndarray, place: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Whether a stretch around each passage has as many words of the unit, in any order, as have to stand there in order."""
        # Texts are set apart by other words, so that no stretch around a passage reaches into the next text.
        words = np.full(int(first[-1]) + GAP * len(first), len(self.units.features), dtype=np.int32)
        words[at + GAP * np.searchsorted(first, at, side="right")] = feature
        place = place + GAP * (text + 1)
        kept = np.zeros(len(unit), dtype=bool)
        flat, width = self.member.ravel(), self.member.shape[1]
        lengths = self.lengths[unit]
        order = np.argsort(lengths, kind="stable")
        for n in np.unique(lengths).tolist():
            least = n if n < SHORT else self.limits.part * n
            reach = np.arange(-n, 2 * HALF + n)
            length = n + max(4, n // 4)
            rows = order[slice(*np.searchsorted(lengths[order], [n, n + 1]))]
            for k in range(0, len(rows), 512):
                own = rows[k : k + 512]
                hit = flat[unit[own, None] * width + words[place[own, None] + reach]]
                seen = np.zeros((len(own), len(reach) + 1), dtype=np.int16)
                np.cumsum(hit, axis=1, out=seen[:, 1:])
                kept[own] = (seen[:, length:] - seen[:, :-length]).max(axis=1) >= least
        return kept

    def verified(self, words: np.ndarray, at: int, unit: int) -> tuple[float, float, int] | None:
        """(share of the unit, share of its answer, first word) of the best stretch around a passage, if it is enough."""
        n = self.masks[unit][-1]
        low, high = max(0, at - n), min(len(words), at + 2 * HALF + n)
        region = words[low:high].tolist()
        # Cheap and exact: no more words stand there in order than stand there at all.
        if sum(map(self.counts[unit].__getitem__, self.known[unit].intersection(region))) < self.limits.part * n:
            return None
        if n < SHORT:
            own = self.units.words[unit].tolist()
            return next(((1.0, 1.0, low + k) for k in range(len(region) - n + 1) if region[k : k + n] == own), None)
        if subsequence(self.masks[unit], region) < self.limits.part * n:
            return None
        length, best = n + max(4, n // 4), (0.0, 0.0, 0)
        for k in range(0, max(1, len(region) - length + max(2, n // 8)), max(2, n // 8)):
            stretch = region[k : k + length]
            share = subsequence(self.masks[unit], stretch) / n
            if share > best[0]:
                best = (share, subsequence(self.answers[unit], stretch) / max(1, self.answers[unit][-1]), low + k)
        share, answer, _ = best
        return best if share >= self.limits.whole or share >= self.limits.part and answer >= self.limits.answer else None


def _search(units, weights, space, limits: Limits):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("common", pa.float64()), ("answer", pa.float64()), ("cosine", pa.float64()), ("first_word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(units.value, weights.value, space.value, limits)
        for batch in batches:
            for piece in T.pieces(batch, "words", _PIECE):
                words, first = entries(piece.column("words"), search.units.kind)
                ids, best = piece.column("doc_id").to_pylist(), {}
                for text, at, unit, cosine in zip(*(x.tolist() for x in search.near(words, first))):
                    key = (text, search.units.items[unit])
                    if key in best and best[key][0] == 1.0:
                        continue
                    found = search.verified(words[first[text] : first[text + 1]], at - int(first[text]), unit)
                    if found and (key not in best or found[:2] > best[key][:2]):
                        best[key] = (found[0], found[1], cosine, found[2])
                if best:
                    rows = [(ids[text], item, *rest) for (text, item), rest in best.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None, limits: Limits = LIMITS, block: int = 256
) -> DataFrame:
    """(doc_id, item_id, common, answer, cosine, first_word): every benchmark item found in a document, its best place.

    `common` is the share of the unit's words found in order, `answer` that of its answer; without `answer_col` an item's last
    sentence is its answer. An item of fewer than 12 words has to stand there whole, without gaps. Null and empty texts hold nothing, and items without a word or an id are not searched. Rows without an id are left
    out; repeated rows and repeated items are found like any other, once for each pair of ids. Only the named columns are read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"), (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer")
    ).where("item_id is not null and text is not null")
    blocks = max(1, -(-items.count() // block))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    hits = None
    for k in range(blocks):
        rows = sorted((r["item_id"], r["text"], r["answer"] or "") for r in items.where(F.col("block") == k).collect())
        units = Units.of(rows)
        if not units.items:
            continue
        shared = spark.sparkContext.broadcast(units)
        home = scratch_path(spark, "coded")
        texts.mapInArrow(_coded(shared), "doc_id long, words binary").write.parquet(home)
        coded = spark.read.schema("doc_id long, words binary").parquet(home)
        counts = _summed(coded.mapInArrow(_counted(shared), "slice int, part binary"), "<i8")
        weights = _weights(units, counts)
        weighed = spark.sparkContext.broadcast(weights)
        own = spark.createDataFrame(pa.table({"words": pa.array([units.numbers(word_hashes(pa.array([t]))[0]).tobytes() for _, t, _ in rows], pa.binary())}))
        emphasis = float(max(1.0, counts.get(-1, [0, 0])[1] / max(1, len(units.items))) ** 0.5)
        passages = coded.select("words", F.lit(1.0).alias("scale")).unionByName(own.withColumn("scale", F.lit(emphasis)))
        sparse = _sparse(shared, weighed)
        matrix = passages.mapInArrow(sparse, "columns binary, vals binary, scale double")
        space = spark.sparkContext.broadcast(randomised_svd(matrix, len(units.features), limits.rank, limits.extra, 11, (passages, sparse)))
        found = materialize(coded.mapInArrow(_search(shared, weighed, space, limits), "doc_id long, item_id long, common double, answer double, cosine double, first_word long"), "hits")
        delete(spark, home)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return spark.createDataFrame([], "doc_id long, item_id long, common double, answer double, cosine double, first_word long")
    best = hits.groupBy("doc_id", "item_id").agg(F.max(F.struct("common", "answer", "cosine", "first_word")).alias("s"))
    return best.select("doc_id", "item_id", "s.*")
