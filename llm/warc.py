"""Web captures as WARC/1.1 archives, written and read by tasks, and put together again from their records.

Each page becomes a transaction: a request, a response (or a revisit, where an equal payload stands in an earlier one) and a metadata record; request
and metadata name the response by WARC-Concurrent-To. Every record is a gzip member of its own. The reader takes any WARC file, compressed or not, in
bounded reads: it holds one record. The assembler joins records by those names, in either direction and over one record in between,
and gives one nested row a capture.

Files are written through pyarrow's file systems to a folder that all executors share, under names of the attempt; only finished attempts
get into the manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from io import BufferedReader
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import materialize, scratch_path

#: Fixed names of the format.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource")
#: A task begins another file after about so many bytes.
FILE_BYTES = 1 << 30
#: A page's part among those with its payload: its only response, the response of several, or a revisit.
_ALONE, _FIRST, _AGAIN = 0, 1, 2
_PRINTABLE = "".join(map(chr, range(33, 127)))
_MANIFEST = "folder string, file string, records long, bytes long"
_MANIFEST_TYPES = pa.schema([("folder", "string"), ("file", "string"), ("records", "int64"), ("bytes", "int64")])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def target_uri(url: str | None) -> str:
    """A URL as a header can hold it; everything but printable ASCII is percent-encoded."""
    return quote(url or "", safe=_PRINTABLE, errors="replace") or "about:blank"


def record(kind: str, ident: str, date: str, headers: list[tuple[str, str]], content_type: str, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", f"WARC-Date: {date}", *(f"{k}: {v}" for k, v in headers)]
    lines += [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Type: {content_type}", f"Content-Length: {len(block)}", "", ""]
    return b"".join(["\r\n".join(lines).encode(), block, b"\r\n\r\n"])


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _request(uri: str) -> bytes:
    host, slash, path = re.match(r"(?:[^:/?#]*://)?([^/?#]*)(/?)([^#]*)", uri).groups()
    return f"GET {slash or '/'}{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()


def transaction(row: dict, naming, serial: str, date: str) -> list[bytes]:
    """Request, response or revisit, and metadata of one page. A response that others revisit is named by its payload, all else by `serial`."""
    uri = target_uri(row["url"])
    payload = (row["html"] or "").encode("utf-8", "surrogatepass")
    digest = f"sha1:{sha1_base32(payload)}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest)]
    if row["part"] == _AGAIN:
        own = naming("capture", serial)
        head += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", f"<{naming('payload', digest)}>"), ("WARC-Refers-To-Date", date)]
        capture = record("revisit", own, date, head, "application/http; msgtype=response", http)
    else:
        own = naming("payload", digest) if row["part"] == _FIRST else naming("capture", serial)
        capture = record("response", own, date, head, "application/http; msgtype=response", http + payload)
    near = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", f"<{own}>")]
    # JSON, so that no URL can break a line.
    fields = f"page-id: {json.dumps(row['page_id'])}\r\nurl: {json.dumps(row['url'])}\r\n".encode()
    return [
        record("request", naming("request", serial), date, near, "application/http; msgtype=request", _request(uri)),
        capture,
        record("metadata", naming("metadata", serial), date, near, "application/warc-fields", fields),
    ]


def _write(folder: str, namespace: str, date: str, file_bytes: int):
    def naming(kind: str, what: str) -> str:
        return uuid.uuid5(uuid.UUID(namespace), f"{kind}:{what}").urn

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        out, name, size, count, files, done = None, "", 0, 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{files:04d}.warc.gz"
                    out, size, count, files = system.open_output_stream(f"{root}/{name}", buffer_size=1 << 20, compression=None), 0, 0, files + 1
                    first = member(record("warcinfo", naming("file", name), date, [("WARC-Filename", name)], "application/warc-fields", b"format: WARC File Format 1.1\r\n"))
                    out.write(first)
                    size += len(first)
                for data in transaction(row, naming, f"{name}:{count}", date):
                    packed = member(data)
                    out.write(packed)
                    size, count = size + len(packed), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((folder, name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((folder, name, count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _MANIFEST_TYPES.types)], schema=_MANIFEST_TYPES)

    return run


def write_warc(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write a transaction for each page and return the manifest, a row for each file: (folder, file, records, bytes).

    Of pages with equal payloads of at least `least_bytes` bytes the one with the smallest id is a response and the others revisit it; null ids come last, and of
    rows that repeat an id any one. Smaller payloads are all responses. A null text is an empty payload, a null URL is about:blank. An empty table
    writes nothing. Only the three named columns are read. `file_bytes` is where a task begins another file.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    text, size = F.coalesce("html", F.lit("")), F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("digest", F.when(size >= least_bytes, F.sha1(text.cast("binary"))))
    # Digests are counted before they travel, and texts are joined with the repeated ones only.
    counts = rows.where("digest is not null").groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    first = counts.groupBy("digest").agg(F.sum("n").alias("all"), F.min(F.struct(F.col("page_id").isNull(), "page_id", "n")).alias("first")).where("all > 1")
    first = materialize(first.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.n").alias("ties")), "repeated")
    rows = rows.join(first, "digest", "left").withColumn("leads", F.col("ties").isNotNull() & F.col("page_id").eqNullSafe(F.col("first_id")))
    part = F.when(F.col("ties").isNull(), _ALONE).when(F.col("leads"), _FIRST).otherwise(_AGAIN)
    columns = ["page_id", "url", "html"]
    if first.where("ties > 1").isEmpty():
        rows = rows.select(*columns, part.alias("part"))
    else:
        # Rows that repeat the smallest id as well: they are numbered, and the least number leads.
        tied = materialize(rows.where("leads and ties > 1").withColumn("number", F.monotonically_increasing_id()), "tied")
        least = tied.groupBy("digest").agg(F.min("number").alias("least"))
        tied = tied.join(least, "digest").select(*columns, F.when(F.col("number") == F.col("least"), _FIRST).otherwise(_AGAIN).alias("part"))
        rows = rows.where("not (leads and ties > 1)").select(*columns, part.alias("part")).unionByName(tied)
    return materialize(rows.mapInArrow(_write(folder, str(uuid.uuid4()), date, file_bytes), _MANIFEST), "manifest")


def manifest_of(spark: SparkSession, folder: str, files: list[str]) -> DataFrame:
    """A manifest of files that others wrote."""
    return spark.createDataFrame([(folder, f, None, None) for f in files], _MANIFEST)


_RECORD = (
    "file string, record_id string, kind string, date string, target_uri string, concurrent_to array<string>, refers_to string, "
    "stated_digest string, http string, fields map<string,string>, payload binary, payload_bytes long, payload_digest string"
)
_RECORD_TYPES = pa.schema(
    [
        ("file", pa.string()), ("record_id", pa.string()), ("kind", pa.string()), ("date", pa.string()), ("target_uri", pa.string()),
        ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("stated_digest", pa.string()), ("http", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)
_CHUNK = 8 << 20


def _lines(source: BufferedReader, where: str) -> list[tuple[str, str]]:
    """Named fields up to an empty line, names in lower case; a line that begins with white space goes on with the one before."""
    out: list[tuple[str, str]] = []
    while line := source.readline():
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return out
        if text[0] in " \t" and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}".strip())
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise ValueError(f"not a header line in {where}: {text[:80]!r}")
        out.append((name.strip().lower(), value.strip()))
    raise ValueError(f"cut off header in {where}")


def _fields(block: bytes) -> dict[str, str]:
    """Named fields of a block; a name that comes again has its values in lines."""
    out: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").splitlines():
        name, colon, value = line.partition(":")
        if colon:
            key = name.strip().lower()
            out[key] = f"{out[key]}\n{value.strip()}" if key in out else value.strip()
    return out


def records_of(source: BufferedReader, where: str) -> Iterator[tuple]:
    """The records of one file in the order of `_RECORD`. Damaged records, and blocks that do not match their digest, raise."""
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins in {where}: {line[:40]!r}")
        headers = _lines(source, where)
        one = dict(reversed(headers))
        size = int(one["content-length"])
        block = source.read(size)
        if len(block) < size:
            raise ValueError(f"cut off record in {where}")
        stated = one.get("warc-block-digest", "")
        if stated.startswith("sha1:") and stated[5:] != sha1_base32(block):
            raise ValueError(f"damaged block in {where}: {one.get('warc-record-id')}")
        kind, content = one.get("warc-type", ""), one.get("content-type", "")
        http, payload, fields = None, block, None
        if content.startswith("application/http"):
            head, blank, payload = block.partition(b"\r\n\r\n")
            http = (head + blank).decode("utf-8", "replace")
        elif content.startswith("application/warc-fields"):
            fields = list(_fields(block).items())
        bare = lambda x: x[1:-1] if x.startswith("<") and x.endswith(">") else x
        near = [bare(v) for k, v in headers if k == "warc-concurrent-to"]
        refers, digest = one.get("warc-refers-to"), one.get("warc-payload-digest")
        yield (
            where, bare(one.get("warc-record-id", "")), kind, one.get("warc-date"), bare(one["warc-target-uri"]) if "warc-target-uri" in one else None, near,
            bare(refers) if refers else None, digest, http, fields, payload, len(payload), sha1_base32(payload),
        )


def _open(system: fs.FileSystem, path: str) -> BufferedReader:
    raw = BufferedReader(system.open_input_stream(path, compression=None, buffer_size=1 << 20), 1 << 20)
    return BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_TYPES.types)], schema=_RECORD_TYPES)

    for batch in batches:
        for row in batch.to_pylist():
            system, root = fs.FileSystem.from_uri(row["folder"])
            held, size = [], 0
            with _open(system, f"{root}/{row['file']}") as source:
                for one in records_of(source, row["file"]):
                    held.append(one)
                    size += one[11] + 500
                    if size >= _CHUNK:
                        yield made(held)
                        held, size = [], 0
            if held:
                yield made(held)


def read_warc(manifest: DataFrame) -> DataFrame:
    """The records of all files, payloads included; `payload_bytes` and `payload_digest` are of the payload as it was read.

    The payload of an HTTP record is what follows its header; a revisit has none. An empty manifest gives no rows.
    """
    files = manifest.select("folder", "file")
    return files.repartition(max(1, files.count()), "file").mapInArrow(_read, _RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row for each response, revisit and resource record: its own columns, `requests` and `metadata`.

    A request or metadata record belongs to the capture that it names by WARC-Concurrent-To or that names it, else to the one of a record so
    linked with it; of several the smallest id. Both lists are in order of record ids and empty where nothing is linked; records linked with no capture are left out.
    Records that repeat an id count once, records without one not at all. `records` is read more than once: store it if reading is dear. Columns that it
    lacks (a payload that was dropped) are left out of the rows.
    """
    records = records.where("record_id <> ''")
    is_capture = F.col("kind").isin(*CAPTURES)
    own = records.where(is_capture).drop("concurrent_to", "fields", "file").dropDuplicates(["record_id"])
    named = records.select("record_id", F.explode("concurrent_to").alias("other"), is_capture.alias("captured"))
    known = records.where(is_capture).select(F.col("record_id").alias("capture")).distinct()
    # Links run both ways; what a capture names counts as naming the capture.
    links = named.where("not captured").select("record_id", "other").unionByName(named.select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
    direct = links.join(known, links["other"] == known["capture"]).groupBy("record_id").agg(F.min("capture").alias("capture"))
    between = links.join(direct.select(F.col("record_id").alias("other"), "capture"), "other").groupBy("record_id").agg(F.min("capture").alias("far"))
    belongs = direct.join(between, "record_id", "full").select("record_id", F.coalesce("capture", "far").alias("capture"))
    parts = [c for c in ("record_id", "date", "target_uri", "http", "fields") if c in records.columns]
    rest = records.where(F.col("kind").isin("request", "metadata")).select("record_id", "kind", F.struct(*parts).alias("part")).dropDuplicates(["record_id"])
    listed = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("part"))), lambda a, b: F.when(a["record_id"] < b["record_id"], -1).otherwise(1))
    rest = rest.join(belongs, "record_id").groupBy("capture").agg(listed("request").alias("requests"), listed("metadata").alias("metadata"))
    out = own.join(rest, own["record_id"] == rest["capture"], "left").drop("capture")
    empty = lambda name: F.coalesce(name, F.array().cast(rest.schema[name].dataType)).alias(name)
    return out.select(*own.columns, empty("requests"), empty("metadata"))


def resolved(rows: DataFrame) -> DataFrame:
    """Captures with `original`: the record id, size, digest and metadata of the response that a revisit refers to; null for others and where it is not at hand.

    `rows` is read twice: store it if it is dear.
    """
    again = F.col("kind") == "revisit"
    first = rows.where(~again).select(F.col("record_id").alias("first_id"), F.struct("record_id", "payload_bytes", "payload_digest", "metadata").alias("original"))
    # What refers to nothing goes by its own id, so that it is spread over all tasks.
    rows = rows.withColumn("first_id", F.when(again, F.coalesce("refers_to", "record_id")).otherwise(F.col("record_id")))
    rows = rows.join(first, "first_id", "left").drop("first_id")
    return rows.withColumn("original", F.when(again, F.col("original")))


def archived_pages(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every capture in the archives."""
    records = read_warc(manifest).select("record_id", "kind", "concurrent_to", "refers_to", "fields", "payload_bytes", "payload_digest")
    rows = resolved(materialize(captures(materialize(records, "records")), "captures"))
    page = lambda metadata: F.try_element_at(F.try_element_at(metadata, F.lit(1))["fields"], F.lit("page-id")).try_cast("long")
    again = F.col("kind") == "revisit"
    return rows.select(
        page(F.col("metadata")).alias("page_id"),
        F.when(again, F.col("original.payload_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("original.payload_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(again, page(F.col("original.metadata"))).alias("refers_to"),
    )
