"""Lines that say nearly the same: MinHash over character shingles, banding, exact comparison, distributed union-find.

1. Every line gets a 128-bit hash and, from its shingles of eight characters, a signature of MinHash values. Equal lines become one.
2. Bands of signature values are buckets. Lines of a bucket are compared with its smallest line first: exact matches give components, so a bucket
   of many near copies costs one comparison a line. Then lines of one bucket that are in different components yet are all compared.
   Such buckets are compared inside tasks, a large one in pairs of blocks: texts travel once for each bucket, pairs never do.
3. Lines are compared by their whole shingle sets; links are joined by the distributed components of `graph`.
4. The first line of each component stays, by document id and line number.

Texts are fetched for lines that share a bucket, and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.graph import components
from llm.groups import in_blocks, smallest_linked, whole_groups
from llm.ngram_jaccard import _among
from meterflow.session import materialize

U64, U32 = np.uint64, np.uint32
CHARS = 8
#: 8 bands of 4 values: two lines of similarity 0.8 share a bucket with probability 0.985, of 0.9 with 0.9999.
BANDS, ROWS = 8, 4
_STEP = 0xB5026F5AA96619E9
_POWERS = T._Cached(_STEP)
#: Lines, and characters, of a block in which all lines are compared.
BLOCK, BLOCK_CHARS = 512, 2 << 20
#: Text of which numpy's temporaries stay in a core's cache.
_PIECE = 512 << 10
_char_value = T.mix(np.arange(1, (1 << 16) + 1, dtype=U64))
_multipliers = (T.mix(np.arange(1, BANDS * ROWS + 1, dtype=U64)) >> U64(32)).astype(U32) | U32(1)


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, A-Z lowered, and the text boundaries in them."""
    raw, bounds = T.buffers(column)
    raw = T.lowered(raw)
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(codes) == len(raw):
        return codes, bounds
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return codes, before[bounds]


def lines(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number in it, start, end) of every line with more than white space; lines end at line feeds, numbers count from 0."""
    feeds = np.flatnonzero(codes == 10)
    starts = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    starts = starts[starts < len(codes)] if len(codes) else starts[:0]
    ends = np.append(starts[1:], len(codes))
    ends = ends - (codes[ends - 1] == 10) if len(starts) else ends[:0]
    text = np.searchsorted(bounds, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, bounds)[text]
    shown = np.concatenate([[0], np.cumsum((codes > 32) & (codes != 0xA0))])
    full = shown[ends] > shown[starts]
    return text[full], number[full], starts[full], ends[full]


def _spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, down = _POWERS.get(len(codes) + 1)
    up, _ = _POWERS.get(len(codes) + 1)
    value = _char_value[np.minimum(codes, 0xFFFF)]
    far = codes > 0xFFFF
    if far.any():
        value[far] = T.mix(codes[far].astype(U64) + U64(1))
    total = np.zeros(len(codes) + 1, dtype=U64)
    np.cumsum(value * up[:-1], out=total[1:])
    return total, down


def line_shingles(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each line's shingles in order, where each line's begin, and a hash of each whole line."""
    total, down = _spans(codes)
    n = np.maximum(1, ends - starts - CHARS + 1)
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - starts, n)
    stop = np.minimum(at + CHARS, np.repeat(ends, n))
    whole = T.mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))
    return (total[stop] - total[at]) * down[at] * U64(0x9E3779B97F4A7C15), begin, whole


_LINES = "doc_id long, line_no long, h_a long, h_b long, keys array<int>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in T.pieces(batch, "text", _PIECE):
            codes, bounds = characters(piece.column("text"))
            text, number, starts, ends = lines(codes, bounds)
            if not len(text):
                continue
            hashes, begin, whole = line_shingles(codes, starts, ends)
            # A second hash of the line: the sum of its scrambled shingles.
            second = np.zeros(len(hashes) + 1, dtype=U64)
            np.cumsum(T.mix(hashes), out=second[1:])
            second = T.mix(second[begin[1:]] - second[begin[:-1]])
            small = (hashes >> U64(32)).astype(U32)
            turned, signature = np.empty_like(small), np.empty((BANDS * ROWS, len(text)), dtype=U32)
            for k, m in enumerate(_multipliers):
                np.multiply(small, m, out=turned)
                np.add(turned, m >> U32(3), out=turned)
                np.minimum.reduceat(turned, begin[:-1], out=signature[k])
            keys = np.zeros((len(text), BANDS), dtype=U64)
            for r in range(ROWS):
                keys = T.mix(keys + signature[r::ROWS].T)
            keys = (keys >> U64(32)).astype(U32).view(np.int32)
            ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[text]), pa.array(number), pa.array(whole.view(np.int64)), pa.array(second.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel())),
                ],
                names=["doc_id", "line_no", "h_a", "h_b", "keys"],
            )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            rows = [(i, n, x) for i, t in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()) for n, x in enumerate((t or "").split("\n")) if x.strip()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "line_no", "line"])


def _sort_each(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where a value of a part equals the one before, after each part has been sorted in place."""
    cuts = begin.tolist()
    for a, b in zip(cuts, cuts[1:]):
        values[a:b].sort()
    same = np.zeros(len(values), dtype=bool)
    np.equal(values[1:], values[:-1], out=same[1:])
    same[begin[:-1]] = False
    return same


def _counted_to(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(marks)])


def _members(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, taken as one line, ascending, and where each text's begin."""
    codes, bounds = characters(column)
    hashes, begin, _ = line_shingles(codes, bounds[:-1], bounds[1:])
    new = ~_sort_each(hashes, begin)
    return hashes[new], _counted_to(new)[begin]


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of each text, taken as one line."""
    out = []
    for piece in T.pieces(pa.RecordBatch.from_arrays([column], names=["line"]), "line", _PIECE):
        values, begin = _members(piece.column("line"))
        cuts = begin.tolist()
        out += [values[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def _in_common(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of the sets that stand at equal places on both sides."""
    both = left[1] + right[1]
    values = np.empty(both[-1], dtype=U64)
    for (own, begin), before in ((left, right[1][:-1]), (right, left[1][1:])):
        values[np.arange(len(own)) + np.repeat(before, np.diff(begin))] = own
    same = _counted_to(_sort_each(values, both))
    return same[both[1:]] - same[both[:-1]]


def _compared(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.pieces(batch, "line_a", _PIECE):
                sides = [_members(piece.column(c)) for c in ("line_a", "line_b")]
                x, y = (np.diff(begin) for _, begin in sides)
                common = _in_common(*sides)
                yield pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b")], names=["a", "b"]).filter(pa.array(100 * common >= least * (x + y - common)))

    return run


def similar(sets: list[np.ndarray], least: int) -> np.ndarray:
    """Which of the sets are similar, as a matrix: products of their incidence with the members that two sets have at least."""
    sizes = np.array([len(x) for x in sets])
    if len(sets) == 2:
        common = _in_common(*((x, np.array([0, len(x)])) for x in sets))[0]
        return np.full((2, 2), 100 * common >= least * (sizes.sum() - common))
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, member, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    owner, member = owner[shared[member]], column[member[shared[member]]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(member, kind="stable")
    owner, member = owner[order], member[order]
    columns = int(shared.sum())
    width = min(columns, max(256, (1 << 22) // len(sets)))
    for k in range(0, columns, width or 1):
        a, b = np.searchsorted(member, [k, k + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[a:b], member[a:b] - k] = 1
        common += part @ part.T
    return 100 * common >= least * (sizes[:, None] + sizes - common)


def _bucket_links(least: int):
    """(a, b): edges that join the linked lines of different components in each group, a row's at most one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            table = table.combine_chunks()
            uid, component, block = (table.column(c).to_numpy() for c in ("uid", "component", "block"))
            group, two = (table.column(c).to_numpy(zero_copy_only=False) for c in ("group", "two"))
            cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            # A group of one component has nothing to find; the lines of the others are taken apart once for all groups here.
            mixed = [(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if (component[a:b] != component[a]).any()]
            if not mixed:
                continue
            at = np.concatenate([np.arange(a, b) for a, b in mixed])
            names, first = np.unique(uid[at], return_index=True)
            known = dict(zip(names.tolist(), _sets(table.column("line").take(pa.array(at[first])).combine_chunks())))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in mixed:
                near = similar([known[u] for u in uid[a:b].tolist()], least) & (component[a:b, None] != component[a:b])
                if two[a]:
                    near &= block[a:b, None] != block[a:b]
                i, j = np.nonzero(np.triu(near, 1))
                if len(i):
                    found.append((uid[a:b][i], uid[a:b][j]))
            if found:
                i, j = (np.concatenate(x) for x in zip(*found))
                names, place = np.unique(np.concatenate([i, j]), return_inverse=True)
                root = names[smallest_linked(len(names), place[: len(i)], place[len(i) :])]
                yield pa.RecordBatch.from_arrays([pa.array(names[names != root]), pa.array(root[names != root])], names=["a", "b"])

    return run


def _links(pairs: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    side = lambda k: texts.select(F.col("uid").alias(k), F.col("line").alias(f"line_{k}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "line_a", "line_b")
    return materialize(rows.mapInArrow(_compared(least), "a long, b long"), "line-links")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 80) -> DataFrame:
    """(doc_id, line_no, first_doc, first_line, kept) of every line with more than white space.

    Lines link when their sets of eight-character shingles, A-Z lowered, have a similarity of `least` hundredths or more; a shorter line is
    one shingle by itself. (first_doc, first_line) is the first line of all that are reachable by links, and `kept` tells whether that is the line itself. Null
    and empty texts have no lines, rows without an id are left out. Rows that repeat an id share its line numbers: equal lines there are
    one line, different ones are two at one place. An empty table gives an empty result. Only the two named columns are read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    found = materialize(docs.mapInArrow(_signatures, _LINES), "lines")
    # Places as text are avoided; a struct's minimum needs the place alone, the keys of equal lines are equal.
    different = found.groupBy("h_a", "h_b").agg(F.min("doc_id").alias("doc_id"), F.min_by("line_no", F.struct("doc_id", "line_no")).alias("line_no"), F.first("keys").alias("keys"))
    different = materialize(different.withColumn("uid", F.monotonically_increasing_id()), "different")
    cells = different.select("uid", F.posexplode("keys").alias("band", "key"))
    cells = cells.select("uid", (F.col("band") * F.lit(1 << 32) + F.col("key")).alias("key"))
    heads = cells.groupBy("key").agg(F.min("uid").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    live = materialize(cells.join(heads, "key"), "live")
    ids = materialize(live.select("uid").distinct().join(different.select("uid", "doc_id", "line_no", "h_a"), "uid"), "ids")
    # A repeated id may have other texts under the same number, so the line's own hash has to agree.
    texts = _among(docs, ids.select("doc_id").distinct()).mapInArrow(_texts, "doc_id long, line_no long, line string")
    texts = materialize(ids.join(texts, ["doc_id", "line_no"]).dropDuplicates(["uid"]).select("uid", "line"), "line-texts")
    stars = live.where("uid <> head").select(F.col("head").alias("a"), F.col("uid").alias("b")).distinct()
    near = _links(stars, texts, least)
    early = components(near, "a", "b").withColumnRenamed("node", "uid")
    labelled = live.select("uid", "key").join(early, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    cells = materialize(labelled.join(mixed, "key").join(texts.select("uid", F.length("line").alias("chars")), "uid"), "open")
    sizes = cells.groupBy("key").agg(F.count("*").alias("n"), F.sum("chars").alias("c"))
    sizes = sizes.select("key", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("c") / BLOCK_CHARS)).alias("blocks"))
    dealt = in_blocks(cells.drop("chars").join(sizes, "key"), "uid", ["key"], 9).join(texts, "uid")
    dealt = dealt.select("group", "uid", "component", "block", "two", "line").repartition(F.col("group")).sortWithinPartitions("group")
    across = materialize(dealt.mapInArrow(_bucket_links(least), "a long, b long"), "line-links")
    whole = components(near.unionByName(across), "a", "b").withColumnRenamed("node", "uid")
    placed = different.select("uid", "h_a", "h_b", "doc_id", "line_no").join(whole, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    first = placed.groupBy("component").agg(F.min("doc_id").alias("first_doc"), F.min_by("line_no", F.struct("doc_id", "line_no")).alias("first_line"))
    named = placed.join(first, "component").select("h_a", "h_b", "first_doc", "first_line")
    return found.select("doc_id", "line_no", "h_a", "h_b").join(named, ["h_a", "h_b"]).select(
        "doc_id", "line_no", "first_doc", "first_line", ((F.col("doc_id") == F.col("first_doc")) & (F.col("line_no") == F.col("first_line"))).alias("kept")
    )
