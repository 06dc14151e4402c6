"""Archives written and read back, foreign archives, and the joining of transactions."""

import base64
import gzip
import hashlib

import pytest

from tableload.llm import warc
from tableload.llm.common import stored

SCHEMA = "page_id long, url string, html string, row string, payload int, digest string"
PAGES = [
    (3, "http://a.example/x?q=1#f", "<p>é</p>", "x", 1, "y"),
    (1, "http://a.example", "<p>é</p>", "x", 1, "y"),
    (2, None, None, None, None, None),
    (4, "no url at all\n", "", None, None, None),
    (5, "http://b.example/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\n\r\n", None, None, None),
    (6, "http://b.example/", "long " * 200_000, None, None, None),
    (7, "http://b.example/", "<p>É</p>", None, None, None),
    (7, "http://b.example/", "<p>É</p>", None, None, None),
    (None, "http://c.example/", "<p>é</p>", None, None, None),
]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_pages_come_back(spark, tmp_path):
    got = warc.archived_pages(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path / "out")).collect()
    assert len(got) == len(PAGES)
    by_page = {}
    for r in got:
        by_page.setdefault(r.page_id, []).append(r)
        assert r.n_requests == r.n_metadata == 1
    for page, _, html, *_ in PAGES:
        for r in by_page[page]:
            assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), sha(html))
    kinds = {p: sorted(r.record_type for r in rows) for p, rows in by_page.items()}
    assert kinds == {1: ["response"], 2: ["response"], 3: ["revisit"], 4: ["revisit"], 5: ["response"], 6: ["response"], 7: ["response", "revisit"], None: ["revisit"]}
    assert by_page[3][0].refers_to == 1 and by_page[4][0].refers_to == 2 and by_page[None][0].refers_to == 1
    assert by_page[3][0].request.http == "GET /x?q=1 HTTP/1.1\r\nHost: a.example\r\n\r\n"
    assert by_page[2][0].target_uri is None and by_page[4][0].target_uri == "no%20url%20at%20all%20"


def test_small_payloads_are_all_responses(spark, tmp_path):
    got = warc.archived_pages(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path / "out"), min_bytes=1).collect()
    assert {r.record_type for r in got if r.page_id in (2, 4)} == {"response"}


def record(kind, record_id, block, *headers):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", *headers, f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    http = "content-type: application/http;\r\n  msgtype=response"  # a folded header
    parts = [
        record("warcinfo", "i", b"software: x\r\n"),
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nWARC/1.0\r\n", http, "WARC-Concurrent-To: <q1>"),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http;msgtype=request"),
        record("metadata", "m1", b"page_id: 5\r\n", "WARC-Concurrent-To: <r1>"),
        record("metadata", "m0", b"page_id: 4\r\n", "WARC-Concurrent-To: <r1>"),
        record("request", "stray", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <nowhere>"),
        record("revisit", "v1", b"HTTP/1.1 200 OK\r\n\r\n", http, "WARC-Refers-To: <lost>", "WARC-Payload-Digest: sha1:ABC"),
    ]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts[:4]))
    (tmp_path / "a" / "two.warc").write_bytes(b"".join(parts[4:]))
    (tmp_path / "a" / "empty.warc").write_bytes(b"")
    records = stored(warc.read_archives(spark, str(tmp_path / "a")), "records")
    assert records.count() == 7
    caught = {r.record_id: r for r in warc.captures(records).collect()}
    assert set(caught) == {"<r1>", "<v1>"}
    one = caught["<r1>"]
    assert bytes(one.payload) == b"body\r\n\r\nWARC/1.0\r\n" and one.request.record_id == "<q1>"
    assert one.metadata.record_id == "<m0>" and (one.n_requests, one.n_metadata) == (1, 2)
    found = {r.record_id: r for r in warc.resolved(stored(warc.captures(records), "caught")).collect()}
    assert found["<r1>"].page_id == 4 and found["<v1>"].payload_digest == "ABC" and found["<v1>"].payload_bytes is None


def test_all_records_of_a_capture_are_kept(spark, tmp_path):
    parts = [
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody", "Content-Type: application/http", "WARC-Concurrent-To: <q2>"),
        record("request", "q2", b"GET /2 HTTP/1.1\r\n\r\n", "Content-Type: application/http"),
        record("request", "q1", b"GET /1 HTTP/1.1\r\n\r\n", "Content-Type: application/http", "WARC-Concurrent-To: <r1>"),
        record("metadata", "m3", b"page_id: 8\r\n", "WARC-Concurrent-To: <r1>"),
        record("metadata", "m2", b"via: x\r\npage_id: 7\r\n", "WARC-Concurrent-To: <r1>"),
        record("metadata", "m1", b"outlink: http://b.example/\r\n", "WARC-Concurrent-To: <r1>"),
        record("response", "r2", b"HTTP/1.1 200 OK\r\n\r\n", "Content-Type: application/http"),
        record("request", "stray", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <nowhere>"),
        record("metadata", "alone", b"page_id: 1\r\n"),
    ]
    (tmp_path / "one.warc").write_bytes(b"".join(parts))
    records = stored(warc.read_archives(spark, str(tmp_path)), "records")
    found = {r.record_id: r for r in warc.resolved(stored(warc.captures(records), "caught")).collect()}
    one, two = found["<r1>"], found["<r2>"]
    assert [x.http for x in (one.request, *one.more_requests)] == ["GET /1 HTTP/1.1\r\n\r\n", "GET /2 HTTP/1.1\r\n\r\n"]
    assert [x.text.split(":")[0] for x in (one.metadata, *one.more_metadata)] == ["outlink", "via", "page_id"]
    assert (one.page_id, one.n_requests, one.n_metadata) == (7, 2, 3)
    assert (two.page_id, two.request, two.more_requests, two.n_requests, two.n_metadata) == (None, None, None, 0, 0)
    lost = warc.unclaimed(records)
    assert lost.columns == records.columns and sorted(r.record_id for r in lost.collect()) == ["<alone>", "<stray>"]


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.parse_archive(record("response", "r", b"body")[:-8]))
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"<html>"))


def test_no_rows(spark, tmp_path):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "out")).count() == 0
