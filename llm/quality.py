"""Document quality by attention over passages: a network that learns from document labels which passages matter.

A passage of 64 words becomes a vector of writing statistics, a small layer encodes it, and gated attention (Ilse and others, 2018)
weighs a document's passages. The weighted sum of the encodings is scored. Only documents carry labels; the weights
of passages are learned from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.language import fold

PASSAGE = 64
#: Classes of bytes: every ASCII sign by itself, then groups.
_UPPER, _LOWER, _DIGIT, _LINE, _SPACE, _HIGH, _CONTROL = range(32, 39)
_CLASSES = 39
_class = np.full(256, _CONTROL, dtype=np.int64)
_signs = [c for c in range(33, 127) if not chr(c).isalnum()]
_class[_signs] = np.arange(len(_signs)) % 32
_class[65:91], _class[97:123], _class[48:58], _class[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_class[10], _class[[9, 32]] = _LINE, _SPACE
FEATURES = _CLASSES + 6


def passage_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(passages, FEATURES), and where each text's passages begin; a text without words has one passage of zeros."""
    raw, bounds = T.buffers(column)
    starts, ends, first = T.words(raw, bounds)
    count = np.diff(first)
    n = np.maximum(1, -(-count // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(n)])
    total = int(begin[-1])
    text_of = np.repeat(np.arange(len(n)), n)
    word_from = first[text_of] + (np.arange(total) - begin[text_of]) * PASSAGE
    word_to = np.minimum(word_from + PASSAGE, first[text_of + 1])
    filled = word_to > word_from
    out = np.zeros((total, FEATURES), dtype=np.float32)
    if not filled.any():
        return out, begin
    passage = np.repeat(np.arange(total), np.where(filled, word_to - word_from, 0))  # of each word
    words = np.where(filled, word_to - word_from, 1).astype(np.float32)
    # The bytes of a passage go to where the next begins, white space after its last word included.
    place = np.flatnonzero(filled)
    last = bounds[text_of[place] + 1]
    same = np.append(text_of[place][1:] == text_of[place][:-1], False)
    stop = np.where(same, np.append(starts[word_from[place][1:]], 0), last)
    go = starts[word_from[place]]
    length = stop - go
    owner = np.repeat(np.arange(len(place)), length)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + go[owner]
    counts = np.bincount(owner * _CLASSES + _class[raw[at]], minlength=len(place) * _CLASSES).reshape(-1, _CLASSES)
    out[place, :32] = counts[:, :32] / words[place, None]
    out[place, 32:_CLASSES] = counts[:, 32:] / np.maximum(1, length)[:, None]
    hashes = T.span_hashes(T.lowered(raw), starts, ends)
    text_of_word = np.repeat(np.arange(len(count)), count)
    repeat = np.zeros(len(starts), dtype=bool)
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    second = np.zeros(len(starts), dtype=bool)
    second[2:] = (hashes[2:] == hashes[:-2]) & (text_of_word[2:] == text_of_word[:-2])
    alone = ends - starts == 1
    order = np.lexsort((hashes, passage))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    share = lambda flags: np.bincount(passage[flags], minlength=total) / words
    k = _CLASSES
    out[:, k], out[:, k + 1], out[:, k + 2] = share(repeat), share(second), share(alone)
    out[:, k + 3] = np.bincount(passage[order][new], minlength=total) / words
    out[:, k + 4] = np.log1p(np.bincount(passage, weights=ends - starts, minlength=total) / words)
    out[:, k + 5] = np.log1p(np.where(filled, words, 0)) / np.log1p(PASSAGE)
    return out, begin


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionModel:
    """Gated attention over encoded passages; scores documents given as (passages, begin)."""

    def __init__(self, encoded: int = 16, gates: int = 8, seed: int = 3):
        draw = np.random.Generator(np.random.PCG64(seed))
        scale = lambda a, b: draw.standard_normal((a, b)) / np.sqrt(a)
        self.p = {
            "w": scale(FEATURES, encoded), "b": np.zeros(encoded), "v": scale(encoded, gates), "u": scale(encoded, gates),
            "a": scale(gates, 1)[:, 0], "c": scale(encoded, 1)[:, 0], "o": np.zeros(1),
        }
        self.mean, self.std = np.zeros(FEATURES), np.ones(FEATURES)

    def scaled(self, passages: np.ndarray) -> np.ndarray:
        return ((passages - self.mean) / self.std).clip(-8, 8)

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        p, owner = self.p, np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * s) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, begin[:-1])[owner])
        a = e / np.add.reduceat(e, begin[:-1])[owner]
        z = np.add.reduceat(h * a[:, None], begin[:-1], axis=0)
        return {"owner": owner, "h": h, "t": t, "s": s, "a": a, "z": z, "score": _sigmoid(z @ p["c"] + p["o"][0])}

    def score(self, passages: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return self.forward(self.scaled(passages), begin)["score"] if len(begin) > 1 else np.zeros(0)

    def gradients(self, x: np.ndarray, begin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, begin)
        owner, h, t, s, a, z = (f[k] for k in ("owner", "h", "t", "s", "a", "z"))
        d = (f["score"] - y) * weight
        dz = (d[:, None] * p["c"])[owner]
        da = (h * dz).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, begin[:-1])[owner])
        dg = de[:, None] * p["a"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
        return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ de, "c": z.T @ d, "o": d.sum(keepdims=True)}

    def fit(self, passages: np.ndarray, begin: np.ndarray, y: np.ndarray, steps: int = 250, rate: float = 0.02, decay: float = 1e-4) -> AttentionModel:
        """Adam over all documents at once. Both labels weigh the same in sum, so a rare one is learned as well."""
        self.mean, self.std = passages.mean(axis=0, dtype=np.float64), passages.std(axis=0, dtype=np.float64) + 1e-3
        x = self.scaled(passages)
        share = np.bincount(y.astype(int), minlength=2)
        weight = 0.5 / np.maximum(1, share)[y.astype(int)]
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            for k, g in self.gradients(x, begin, y, weight).items():
                g = g + decay * self.p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _bags(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                features, begin = passage_features(piece.column("text"))
                bags = []
                for a, b in zip(begin[:-1], begin[1:]):
                    pick = np.arange(a, b) if b - a <= most else np.linspace(a, b - 1, most).astype(int)
                    bags.append(features[pick].astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("quality"), pa.array(bags, pa.binary())], names=["doc_id", "quality", "bag"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sampled_docs: int, sampled_passages: int) -> AttentionModel | None:
    """The model of a bounded sample of labelled rows that are not held out; None where none has a label.

    Bounds: about `sampled_docs` labelled documents, chosen by a hash of their ids, with `sampled_passages` passages each, evenly spaced.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("quality")).where("_id is not null and quality in (0, 1)")
    known = known.where(fold("_id") != 0).groupBy("_id").agg(F.max("quality").alias("quality"))
    rows = known.count()
    if not rows:
        return None
    place = F.pmod(F.xxhash64(F.lit("quality"), "_id"), F.lit(1 << 30))
    chosen = known.where(place <= int(min(1.0, sampled_docs / rows) * (1 << 30)))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "quality", "text")
    bags = texts.mapInArrow(_bags(sampled_passages), "doc_id long, quality int, bag binary").toPandas().sort_values(["doc_id", "bag"])
    if not len(bags):
        return None
    parts = [np.frombuffer(x, "<f4").reshape(-1, FEATURES) for x in bags.bag]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return AttentionModel().fit(np.concatenate(parts), begin, bags.quality.to_numpy(float))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, sampled_docs: int = 2000, sampled_passages: int = 32, row_col: str | None = None
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, read as a whole text; with `row_col` that column as a long `row` as well.

    Rows whose crc32(id as text) modulo 5 is 0 are held out of the fit; a null id is held out too. Scores come from the text alone. A null
    text is an empty one, with a score like any other. Labels other than 0 and 1 are ignored, of a repeated id's labels the
    largest counts. Without labels every score is 0.5. Only the named columns are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_col, text_col, label_col, sampled_docs, sampled_passages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch, "text"):
                if model.value is None:
                    score = np.full(piece.num_rows, 0.5)
                else:
                    score = model.value.score(*passage_features(piece.column("text")))
                columns = [*(piece.column(c) for c in names), pa.array(score.astype(np.float64)), pa.array((score >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "score", "predicted"])

    names = ["doc_id", "held_out", *(["row"] if row_col else [])]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).alias("text"), *([F.col(row_col).cast("long").alias("row")] if row_col else [])
    )
    return rows.mapInArrow(run, f"doc_id long, held_out boolean, {'row long, ' if row_col else ''}score double, predicted int")
