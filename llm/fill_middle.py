"""Texts rearranged for fill-in-the-middle training, and put back together from what was written.

A text is cut into prefix, middle and suffix at two unit ends. The bytes of all texts of a batch lie end to end, so the move of each
part is two entries of a difference array: its running sum is the shift of every byte, and one scatter builds all outputs. Putting a text back
scans the outputs for the marks, lays out the opposite shifts and gathers. Both go over the bytes in bounded windows.

Marks begin with `<`, end with `>` and stand nowhere in a rearranged text, so none can come about where two parts meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.text import buffers, pieces, words

#: Fixed marks: prefix, suffix, middle.
MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
_MARK = 3
_WINDOW = 1 << 20
#: The order of the parts (0 prefix, 1 middle, 2 suffix) in the output, by form.
_ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
#: The mark before each part.
_BEFORE = (0, 2, 1)


def unit_ends(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The end byte of every unit, and the first unit of each text (with the total at the end).

    A unit is a word with the white space before it; white space after the last word is a unit of its own.
    """
    _, ends, first = words(raw, bounds)
    last = np.where(np.diff(first) > 0, np.concatenate([ends, [0]])[np.maximum(first[1:] - 1, 0)], bounds[:-1])
    tail = last < bounds[1:]
    ends = np.insert(ends, first[1:][tail], bounds[1:][tail])
    return ends, first + np.concatenate([[0], np.cumsum(tail)])


def mark_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where marks begin, and which (0 prefix, 1 suffix, 2 middle)."""
    at = np.flatnonzero(raw[: max(len(raw) - 2, 0)] == ord("<"))
    at = at[raw[at + 2] == ord(">")]
    which = np.full(len(at), -1)
    for k, mark in enumerate(MARKS):
        which[raw[at + 1] == mark[1]] = k
    return at[which >= 0], which[which >= 0]


def _holds_mark(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    at, _ = mark_places(raw)
    text = np.searchsorted(bounds, at, side="right") - 1
    found = np.zeros(len(bounds) - 1, dtype=bool)
    found[text[at + _MARK <= bounds[text + 1]]] = True
    return found


def _shifts(starts: np.ndarray, moves: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, shift of each byte) by windows; `starts` ascending, where `moves` begin to hold.

    Moves go into a difference array, so of several that begin at one byte (empty parts) the last one holds.
    """
    jumps = np.diff(moves, prepend=0)
    carried, k = 0, 0
    for at in range(0, size, _WINDOW):
        n = min(_WINDOW, size - at)
        steps = np.zeros(n, dtype=np.int64)
        end = int(np.searchsorted(starts, at + n))
        np.add.at(steps, starts[k:end] - at, jumps[k:end])
        steps[0] += carried
        shift = np.cumsum(steps)
        carried, k = int(shift[-1]), end
        yield at, shift


def code_points(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of code points in each span of UTF-8 bytes."""
    total = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return total[ends] - total[begins]


def rearrange(raw: np.ndarray, bounds: np.ndarray, cuts: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs end to end, and their boundaries. `cuts` (texts, 2) are the bytes after prefix and middle."""
    length = np.diff(bounds)
    marked = forms != PLAIN
    out_bounds = np.concatenate([[0], np.cumsum(length + marked * _MARK * len(MARKS))])
    begins = np.column_stack([bounds[:-1], cuts])
    sizes = np.diff(np.column_stack([begins, bounds[1:]]), axis=1)
    places = begins - bounds[:-1, None] + out_bounds[:-1, None]
    out = np.empty(out_bounds[-1], dtype=np.uint8)
    for form, order in _ORDER.items():
        rows = np.flatnonzero(forms == form)
        at = out_bounds[rows]
        for part in order:
            out[at[:, None] + np.arange(_MARK)] = np.frombuffer(MARKS[_BEFORE[part]], dtype=np.uint8)
            places[rows, part] = at + _MARK
            at = at + _MARK + sizes[rows, part]
    for at, shift in _shifts(begins.ravel(), (places - begins).ravel(), len(raw)):
        out[np.arange(at, at + len(shift)) + shift] = raw[at : at + len(shift)]
    return out, out_bounds


def put_back(out: np.ndarray, bounds: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs, end to end, and their boundaries; an output without its three marks in their order is refused."""
    at, which = mark_places(out)
    text = np.searchsorted(bounds, at, side="right") - 1
    use = forms[text] != PLAIN
    at, which, text = at[use], which[use], text[use]
    marked = np.flatnonzero(forms != PLAIN)
    if len(at) != 3 * len(marked) or (text != np.repeat(marked, 3)).any():
        raise ValueError("an output does not hold each mark once")
    at, which = at.reshape(-1, 3), which.reshape(-1, 3)
    length = np.diff(bounds) - (forms != PLAIN) * _MARK * len(MARKS)
    back_bounds = np.concatenate([[0], np.cumsum(length)])
    # A plain text is one part; of a marked one the three parts are taken in the order of the text.
    sources = np.repeat(bounds[:-1, None], 3, axis=1)
    sizes = np.column_stack([length, np.zeros((len(length), 2), dtype=np.int64)])
    ends = np.column_stack([at[:, 1:], bounds[marked + 1]])
    for form, order in _ORDER.items():
        own = forms[marked] == form
        if (which[own] != [_BEFORE[p] for p in order]).any() or (at[own][:, :1] != bounds[marked[own], None]).any():
            raise ValueError("marks out of order")
        for place, part in enumerate(order):
            sources[marked[own], part] = at[own, place] + _MARK
            sizes[marked[own], part] = ends[own, place] - at[own, place] - _MARK
    begins = back_bounds[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    back = np.empty(back_bounds[-1], dtype=np.uint8)
    for first, shift in _shifts(begins.ravel(), (sources - begins).ravel(), len(back)):
        back[first : first + len(shift)] = out[np.arange(first, first + len(shift)) + shift]
    return back, back_bounds


def _strings(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    texts = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
    return texts.cast(pa.string()) if len(raw) < 1 << 31 else texts


_KINDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _transform(rate: int, suffix_first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                raw, bounds = buffers(batch.column("text"))
                h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4))
                ends, first = unit_ends(raw, bounds)
                n = np.diff(first)
                plain = (np.diff(bounds) == 0) | _holds_mark(raw, bounds) | (h3 % 100 >= rate)
                forms = np.where(plain, PLAIN, np.where(h4 % 100 < suffix_first, SPM, PSM))
                # The place of the k-th unit's end; none for k = 0, where the text itself begins.
                units = np.sort(np.column_stack([h1 % (n + 1), h2 % (n + 1)]), axis=1)
                cuts = np.where(units > 0, np.concatenate([ends, [0]])[np.maximum(first[:-1, None] + units - 1, 0)], bounds[:-1, None])
                prefix = code_points(raw, bounds[:-1], cuts[:, 0])
                middle = code_points(raw, cuts[:, 0], cuts[:, 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(n.astype(np.int64)),
                        pa.array(FORMS).take(pa.array(forms)),
                        pa.array(prefix, mask=plain),
                        pa.array(middle, mask=plain),
                        _strings(*rearrange(raw, bounds, cuts, forms)),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, suffix_first: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    Cuts and form come from the SHA-256 of `seed:id`, so they hang on the id alone: `rate` per cent of the texts are rearranged, of these
    `suffix_first` per cent with the suffix first. A null text is empty; an empty text and one that holds a mark stay plain, with null
    lengths. A null id is hashed as nothing after the colon. Rows that repeat an id are cut alike, each by its own units, and equal rows come out as
    often as they come in. A text is rearranged whole, however long. An empty table gives an empty result; only the two named columns are read.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("digest", digest)
    parts = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return rows.select("doc_id", "text", *parts).mapInArrow(_transform(rate, suffix_first), _KINDS)


def restored(rows: DataFrame, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """`rows` with a column `restored`: the text of each output, from the output and its form alone.

    A null output or form gives an empty text's row as it would a plain one. A rearranged output whose marks are damaged raises.
    """
    schema = rows.drop("restored").schema.add("restored", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, output_col):
                raw, bounds = buffers(batch.column(output_col))
                forms = np.array([FORMS.index(x or FORMS[PLAIN]) for x in batch.column(form_col).to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, _strings(*put_back(raw, bounds, forms))], names=[*batch.schema.names, "restored"])

    return rows.drop("restored").mapInArrow(run, schema)


def fill_middle_digests(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row: digests of the outputs and of what they give back."""
    rows = restored(fill_middle(docs, **options))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )
