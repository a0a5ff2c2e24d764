import base64
import gzip
import hashlib
import io
import os
from collections import defaultdict

import pytest

from llm.warc import archived_pages, captures, manifest_of, member, read_warc, record, records_of, resolved, sha1_base32, target_uri, write_warc

EXTRA = "row long, digest string, size long, first_row long, folder string, file string, kind string, record_id string, payload string, first string, n int, html_ string"
PAGES = f"page_id long, url string, html string, {EXTRA}"
DATE = "2020-02-02T00:00:00Z"


def pages(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 12) for r in rows], PAGES).repartition(3)


def plainly(rows, least=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for html, ids in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids.sort(key=lambda i: (i is None, i))
        for k, i in enumerate(ids):
            again = k > 0 and len(data) >= least
            out.append((i, len(data), digest, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_small_tables(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    assert found(archived_pages(write_warc(rows))) == plainly([tuple(r) for r in rows.collect()])


EDGES = [
    (5, "http://a.example/x?y=1#z", "<p>one</p>"), (3, "http://b.example", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "http://b.example", "<p>one</p>"),
    (1, "http://c.example/\r\nWARC-Type: forged\n☃ <x>", None), (2, "no scheme at all", ""), (4, "", " "), (None, "http://[broken", "x\r\n\r\ny"), (None, None, None), (6, "u", "x\r\n\r\ny"),
    (7, "http://long.example/" + "p" * 70_000, "é☃" * 400_000), (8, "http://w.example", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
]


@pytest.mark.parametrize("least", [0, 1, 2, 11])
def test_edges(spark, least):
    assert found(archived_pages(write_warc(pages(spark, EDGES), least_bytes=least))) == plainly(EDGES, least)
    assert found(archived_pages(write_warc(pages(spark, [])))) == []


def test_a_payload_of_a_third_of_all_pages_and_more_files(spark):
    rows = [(i, f"http://h.example/{i}", "same" if i % 3 == 0 else f"page {i}") for i in range(3000)]
    manifest = write_warc(pages(spark, rows), file_bytes=50_000)
    assert manifest.count() > 3 and manifest.groupBy().sum("records").first()[0] == 9000
    assert found(archived_pages(manifest)) == plainly(rows)


def test_nested_rows_hold_the_whole_transaction(spark):
    rows = captures(read_warc(write_warc(pages(spark, EDGES)))).collect()
    assert len(rows) == len(EDGES) and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in rows)
    urls = {r["metadata"][0]["fields"]["url"]: r for r in rows}
    row = urls['"http://a.example/x?y=1#z"']
    assert row["requests"][0]["http"] == "GET /x?y=1 HTTP/1.1\r\nHost: a.example\r\n\r\n" and row["target_uri"] == "http://a.example/x?y=1#z"
    assert row["kind"] == "revisit" and bytes(row["payload"]) == b"" and row["stated_digest"] == "sha1:" + sha1_base32(b"<p>one</p>")
    whole = {bytes(r["payload"]).decode() for r in rows if r["kind"] == "response"}
    assert whole == {h or "" for _, _, h in EDGES}


def http(body):
    return b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n" + body


def foreign():
    page = "application/http; msgtype=response"
    return b"".join(
        [
            record("warcinfo", "urn:i", DATE, [], "application/warc-fields", b"software: other\r\n"),
            # A response that names its request; the metadata record names the request.
            record("response", "urn:b", DATE, [("WARC-Target-URI", "<http://x>"), ("WARC-Concurrent-To", "<urn:a>")], page, http(b"one")),
            record("request", "urn:a", DATE, [], "application/http; msgtype=request", b"GET / HTTP/1.1\r\n\r\n"),
            record("metadata", "urn:m", DATE, [("WARC-Concurrent-To", "<urn:a>")], "application/warc-fields", b"via: y\r\nvia: z\r\nodd\r\n"),
            # Two names, a folded line, and a record that nothing captures.
            record("metadata", "urn:n", DATE, [("WARC-Concurrent-To", "<urn:zz>"), ("WARC-Concurrent-To", "\r\n <urn:c>")], "text/plain", b"free"),
            record("revisit", "urn:c", DATE, [("WARC-Refers-To", "<urn:b>")], page, http(b"")),
            record("request", "urn:lost", DATE, [("WARC-Concurrent-To", "<urn:nowhere>")], "text/plain", b""),
            record("resource", "urn:r", DATE, [], "text/plain", b"alone"),
            record("revisit", "urn:d", DATE, [("WARC-Refers-To", "<urn:elsewhere>")], page, http(b"")),
        ]
    )


@pytest.mark.parametrize("packing", ["plain", "whole", "members"])
def test_other_archives(spark, tmp_path, packing):
    data = foreign()
    records = [(r[1], r[2]) for r in records_of(io.BufferedReader(io.BytesIO(data)), "x")]
    packed = {"plain": data, "whole": gzip.compress(data), "members": member(data[:700]) + member(data[700:])}[packing]
    for name in ("one.warc", "again.warc"):
        (tmp_path / name).write_bytes(packed)
    have = read_warc(manifest_of(spark, f"file://{tmp_path}", ["one.warc"]))
    assert [(r["record_id"], r["kind"]) for r in have.collect()] == records and len(records) == 9
    # The same archive twice: its records count once.
    twice = read_warc(manifest_of(spark, f"file://{tmp_path}", os.listdir(tmp_path)))
    rows = {r["record_id"]: r for r in resolved(captures(twice)).collect()}
    assert sorted(rows) == ["urn:b", "urn:c", "urn:d", "urn:r"] and resolved(captures(twice)).count() == 4
    assert [x["record_id"] for x in rows["urn:b"]["requests"]] == ["urn:a"] and rows["urn:b"]["metadata"][0]["fields"] == {"via": "y\nz"}
    assert rows["urn:b"]["target_uri"] == "http://x" and rows["urn:b"]["payload_digest"] == sha1_base32(b"one")
    assert [x["record_id"] for x in rows["urn:c"]["metadata"]] == ["urn:n"] and rows["urn:c"]["original"]["record_id"] == "urn:b"
    assert rows["urn:r"]["requests"] == rows["urn:r"]["metadata"] == [] and bytes(rows["urn:r"]["payload"]) == b"alone"
    assert rows["urn:d"]["original"] is None


def test_damaged_archives_are_refused():
    data = foreign()
    for broken in (data[:-30], data.replace(b"alone", b"alonf"), data.replace(b"WARC/1.1", b"WORC/1.1", 1)):
        with pytest.raises(ValueError):
            list(records_of(io.BufferedReader(io.BytesIO(broken)), "x"))


def test_targets_fit_in_a_header():
    assert target_uri(None) == target_uri("") == "about:blank" and target_uri("http://a/ \n☃") == "http://a/%20%0A%E2%98%83"
