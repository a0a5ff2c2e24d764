"""Whole Arrow columns of text as numpy arrays: words, shingles and their 64-bit hashes.

Words are runs of anything but ASCII white space, with A-Z lowered; both work on UTF-8 bytes, so
letters outside ASCII stay as they are. Hashes depend on the bytes alone, never on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
WORDS = 5
#: Fixed odd multipliers of the polynomial and of the finaliser.
_BYTE_STEP, _WORD_STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)

_white = np.zeros(256, dtype=bool)
_white[[9, 10, 11, 12, 13, 32]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32

_plain = _lower.copy()
_plain[[c for c in range(128) if not chr(c).isalnum()]] = 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(_MIX[0])
    x = x ^ (x >> U64(33))
    x = x * U64(_MIX[1])
    return x ^ (x >> U64(33))


_byte_value = mix(np.arange(1, 257, dtype=U64))


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, U64(step))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse(step: int) -> int:
    return pow(step, -1, 1 << 64)


class _Cached:
    """Powers of one multiplier and of its inverse, grown when a longer text comes."""

    def __init__(self, step: int):
        self.step, self.up, self.down = step, np.zeros(0, U64), np.zeros(0, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = _powers(self.step, size), _powers(_inverse(self.step), size)
        return self.up[:n], self.down[:n]


_POWERS = _Cached(_BYTE_STEP)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the text boundaries in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    return _lower[raw]


def plained(raw: np.ndarray) -> np.ndarray:
    """Lower case, and a space for every ASCII byte that is neither letter nor digit."""
    return _plain[raw]


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each text (with the total at the end)."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_white[raw]
    change = np.diff(inside)
    # A text also ends a word; only neighbours that touch need the extra cut.
    cuts = bounds[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(raw))])
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    up, down = _POWERS.get(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=U64)
    np.cumsum(_byte_value[raw] * up[:-1], out=total[1:])
    # Polynomials alone are weak in the low bits, so the length and a finaliser are mixed in.
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(_WORD_STEP))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `size` words, in text order, and where each text's runs begin.

    A text with fewer words has the whole sequence as its only run, one without words none.
    """
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(count)), n)
    at = np.arange(begin[-1]) - begin[owner] + first[owner]
    length = np.minimum(count[owner], size)
    out = length.astype(U64)
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    for k in range(size):
        out = np.where(k < length, mix(out * U64(_WORD_STEP) + padded[at + k]), out)
    return out, begin


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each group's distinct values in ascending order."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], np.searchsorted(owner[keep], np.arange(len(begin)))


def pieces(batch: pa.RecordBatch, column: str, most: int = 512 << 10) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes of text each, so that numpy's temporaries stay bounded.

    A single longer text is a slice by itself.
    """
    _, bounds = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def shingle_sets(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a column, ascending, and where each text's begin."""
    raw, bounds = buffers(column)
    raw = lowered(raw)
    starts, ends, first = words(raw, bounds)
    return distinct(*shingles(span_hashes(raw, starts, ends), first, size))
