"""Texts as token ids in length-delimited binary records, with an offset index beside each file.

A data file is a run of records, each

    length of the payload   unsigned 64 bit
    masked CRC-32 of those 8 bytes   unsigned 32 bit
    payload: the document's id (signed 64 bit, with a flag byte for a missing one), then its token ids
    masked CRC-32 of the payload   unsigned 32 bit

all little-endian. Ids take 16 bits where the vocabulary allows, else 32. The mask rotates a checksum right by 15 bits
and adds a constant, so that checksums of data which holds checksums stay useful. The index file has the offset of every record as
unsigned 64 bit and the file's length at the end, so any record can be read by itself, in any order.

Files are written and read by the tasks through pyarrow's file systems, to a folder that all executors share. Each attempt has
its own names and only finished attempts get into the manifest, so a lost executor or a repeated task leaves no half file in it.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice
from string import punctuation

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.session import materialize, scratch_path

#: Fixed constant of the record format.
MASK = 0xA282EAD8
HEAD = np.dtype([("length", "<u8"), ("check", "<u4")])
#: Different units whose ids a worker remembers; beyond it, it keeps the first quarter, which has the frequent ones.
REMEMBERED = 1 << 20
_CHUNK = 8 << 20
_MANIFEST = "file string, part int, records long, tokens long, bytes long, width int"

_odd_space = re.compile(r" \s")
_unit_start = re.compile(r" (?=\S)")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join([length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")])


def payload_of(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The checked payload of the record at `at`, and where the next one begins."""
    length = bytes(data[at : at + 8])
    if len(length) < 8 or masked(length) != int.from_bytes(data[at + 8 : at + 12], "little"):
        raise ValueError(f"damaged record length at byte {at}")
    end = at + 12 + int.from_bytes(length, "little")
    payload = data[at + 12 : end]
    if len(data) < end + 4 or masked(payload) != int.from_bytes(data[end : end + 4], "little"):
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + 4


class Encoder:
    """Token ids of whole texts by a tokenizer of the `tokenizers` library, as bytes of 16- or 32-bit integers.

    With a byte-level tokenizer that splits texts by its standard pattern, a space before anything but white space always begins a
    piece that is encoded by itself. So texts are cut there and each different unit is encoded once. ASCII marks at the end of a unit,
    after a letter or digit, are a piece as well: the unit's ids are those of its stem and of its marks.
    Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        # A task has its core, and the library would start a thread for each of the machine's.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.code, self.width = ("H", 2) if size <= 1 << 16 else ("I", 4)
        self.units: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        # The library finds added tokens before it cuts: one that ends in marks may not lose them.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = tuple(t.rstrip(punctuation) for t in added if t[-1:] in punctuation and t.rstrip(punctuation))
        self.first = np.zeros(size, dtype=bool)
        self.first[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("Ġ")]] = True
        made = str(self.tokenizer.pre_tokenizer)
        self.cuts = self.tokenizer.normalizer is None and made.startswith("ByteLevel(") and "add_prefix_space=False" in made and "use_regex=True" in made

    def plain(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def stem(self, unit: str) -> str:
        """The unit without the marks at its end, or all of it where those are no piece by themselves."""
        stem = unit.rstrip(punctuation)
        last = stem[-1:]
        return stem if last and (last.isalpha() and last < "\u0250" or last.isascii() and last.isdigit()) and not stem.endswith(self.whole) else unit

    def tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) >= 1 << 16:
                self.tails.clear()
            self.tails[marks] = self.plain(marks)
        return self.tails[marks]

    def learn(self, units: list[str]) -> None:
        stems = list(map(self.stem, units))
        self.learn_stems(list(set(stems).difference(self.units)))
        known = self.units
        for unit, stem in zip(units, stems):
            if len(stem) < len(unit):
                known[unit] = known[stem] + self.tail(unit[len(stem) :])

    def learn_stems(self, units: list[str]) -> None:
        ids = np.frombuffer(self.plain("".join([" " + x for x in units])), dtype=self.code)
        starts = np.flatnonzero(self.first[ids])
        if len(starts) == len(units) and (not len(starts) or starts[0] == 0):
            raw, ends = ids.tobytes(), [*(starts[1:] * self.width).tolist(), ids.nbytes]
            self.units.update(zip(units, [raw[a:b] for a, b in zip([0, *ends], ends)]))
        else:
            for unit in units:
                self.units[unit] = self.plain(" " + unit)

    def encode(self, text: str) -> bytes:
        if not self.cuts:
            return self.plain(text)
        units = _unit_start.split(text) if _odd_space.search(text) else text.split(" ")
        first = self.plain(units[0])
        del units[0]
        ids = list(map(self.units.get, units))
        if None in ids:
            if len(self.units) >= REMEMBERED:
                self.units = dict(islice(self.units.items(), REMEMBERED // 4))
            new = [k for k, x in enumerate(ids) if x is None]
            self.learn(list({units[k] for k in new}))
            for k in new:
                ids[k] = self.units[units[k]]
        return first + b"".join(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        last = array(coder.code, [end_id]).tobytes()
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        system, root = fs.FileSystem.from_uri(folder)
        data, offsets, at, tokens = None, array("Q"), 0, 0
        for batch in batches:
            for ident, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if data is None:
                    data = system.open_output_stream(f"{root}/{name}.bin", buffer_size=1 << 20)
                ids = coder.encode(text.as_py() or "") + last
                record = framed((b"\0" if ident is None else b"\1") + (ident or 0).to_bytes(8, "little", signed=True) + ids)
                data.write(record)
                offsets.append(at)
                at += len(record)
                tokens += len(ids) // coder.width
        if data is not None:
            data.close()
            offsets.append(at)
            with system.open_output_stream(f"{root}/{name}.idx") as out:
                out.write(offsets.tobytes())
            row = {"file": [name], "part": [context.partitionId()], "records": [len(offsets) - 1], "tokens": [tokens], "bytes": [at], "width": [coder.width]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("file", "string"), ("part", "int32"), ("records", "int64"), ("tokens", "int64"), ("bytes", "int64"), ("width", "int32")]))

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Write every whole text, ids in ascending order, and return the manifest: a row for each file.

    (folder, file, part, records, tokens, bytes, width, start); `start` counts the ids in all files before. A null text is an empty
    one: its record holds the end id alone. A null id sorts first; rows that repeat an id are records of their own, in order of
    their texts. An empty table writes nothing. Only the two named columns are read.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = materialize(rows.mapInArrow(_write(folder, tokenizer, end_id), _MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select(F.lit(folder).alias("folder"), "*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))


def _records(system: fs.FileSystem, path: str) -> Iterator[memoryview]:
    """Checked payloads of a whole file, in bounded reads."""
    with system.open_input_file(path) as source:
        held, at = memoryview(b""), 0
        while True:
            need = 12
            if len(held) - at >= 12:
                need = 16 + int.from_bytes(held[at : at + 8], "little")
                if masked(held[at : at + 8]) != int.from_bytes(held[at + 8 : at + 12], "little"):
                    raise ValueError(f"damaged record length in {path}")
            if len(held) - at < need:
                more = source.read(max(_CHUNK, need))
                if not more:
                    if len(held) > at:
                        raise ValueError(f"cut off record in {path}")
                    return
                held, at = memoryview(bytes(held[at:]) + more), 0
                continue
            payload, at = payload_of(held, at)
            yield payload


def _read(column: str, kind: pa.DataType, value):
    """Rows (doc_id, start, n_tokens, column) of the files; `value` makes the column from the ids as unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (column, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, root = fs.FileSystem.from_uri(row["folder"])
                start, out, size = row["start"], [], 0
                for payload in _records(system, f"{root}/{row['file']}.bin"):
                    ids = np.frombuffer(payload[9:], dtype=f"<u{row['width']}").astype("<u4").tobytes()
                    out.append((int.from_bytes(payload[1:9], "little", signed=True) if payload[0] else None, start, len(ids) // 4, value(ids)))
                    start, size = start + len(ids) // 4, size + len(ids)
                    if size >= _CHUNK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return run


def _files(manifest: DataFrame) -> DataFrame:
    return manifest.select("folder", "file", "width", "start").repartition(max(1, manifest.count()), "file")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record of the files; `ids` holds unsigned 32-bit integers."""
    return _files(manifest).mapInArrow(_read("ids", pa.binary(), lambda ids: ids), "doc_id long, start long, n_tokens long, ids binary")


def read_records(folder: str, file: str, width: int, picks: list[int]) -> list[np.ndarray]:
    """The ids of the picked records of one file, in the order of `picks`, by way of its offset index."""
    system, root = fs.FileSystem.from_uri(folder)
    out = []
    with system.open_input_file(f"{root}/{file}.idx") as index, system.open_input_file(f"{root}/{file}.bin") as data:
        for k in picks:
            index.seek(8 * k)
            begin, end = np.frombuffer(index.read(16), dtype="<u8").tolist()
            data.seek(begin)
            payload, _ = payload_of(memoryview(data.read(end - begin)), 0)
            out.append(np.frombuffer(payload[9:], dtype=f"<u{width}").astype(np.int64))
    return out


def token_index(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read back from the files."""
    return _files(manifest).mapInArrow(_read("ids_crc32", pa.int64(), zlib.crc32), "doc_id long, start long, n_tokens long, ids_crc32 long")
