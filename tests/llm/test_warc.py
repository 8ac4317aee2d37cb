"""WARC archives: round trip against the contract, record syntax, and hand-made archives."""

import gzip
import hashlib
import io

import pytest

from millrace.llm import warc


def slow(rows):
    first = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        if page_id is not None:
            first[raw] = min(page_id, first.get(raw, page_id))
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 100 and first.get(raw) is not None and first[raw] != page_id
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[raw] if revisit else None))
    return out


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    same(warc.round_trip(pages).collect(), slow([tuple(r) for r in pages.select("page_id", "url", "html").collect()]))


def test_edge_cases(spark):
    body = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(5, "http://a.example/x y?q=1#f", body), (3, None, body), (3, "http://b", body), (9, "", body), (None, "http://c", body)]
    rows += [(1, "http://d", None), (2, "http://d", ""), (2, "http://d", ""), (7, "http://e", "x" * 99), (8, "http://e", "x" * 99), (10, "http://e", "y" * 100), (11, "http://e", "y" * 100)]
    rows += [(12, "http://f\r\nWARC-Type: x", "z" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    same(warc.round_trip(pages).collect(), slow(rows))
    assert warc.round_trip(pages.limit(0)).collect() == []
    only_null = spark.createDataFrame([(None, "u", "n" * 200), (None, "u", "n" * 200)], "page_id long, url string, html string")
    same(warc.round_trip(only_null).collect(), slow([(None, "u", "n" * 200)] * 2))


def test_nested_rows(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/b?c=d", "hello" * 40), (2, "http://e", "hello" * 40)], "page_id long, url string, html string")
    found = warc.read_back(spark, warc.write(pages, f"file://{tmp_path}/warc")).cache()
    rows = sorted(warc.assemble(found).collect(), key=lambda r: r.metadata.payload)
    assert [bytes(r.metadata.payload) for r in rows] == [b"page-id: 1\r\n", b"page-id: 2\r\n"]
    one, two = rows
    assert one.response.type == "response" and bytes(one.response.payload) == b"hello" * 40
    assert two.response.type == "revisit" and two.response.refers_to == one.capture_id and two.response.http_length == 200
    assert bytes(one.request.payload).startswith(b"GET /b?c=d HTTP/1.1\r\nHost: a\r\n")
    assert one.target_uri == "http://a/b?c=d"
    found.unpersist()


def test_parser():
    raw = warc.record([("WARC-Type", "request"), ("X-Long", "a\r\n b")], b"one\r\n\r\ntwo") + warc.record([("WARC-Type", "metadata")], b"")
    stream = io.BytesIO(gzip.compress(raw[:40]) + gzip.compress(raw[40:]))
    got = list(warc.records(io.BufferedReader(gzip.GzipFile(fileobj=stream))))
    assert [(h["warc-type"], b) for h, b in got] == [("request", b"one\r\n\r\ntwo"), ("metadata", b"")]
    assert got[0][0]["x-long"] == "a b"
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(raw[:-12])))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(b"HTTP/1.1 200 OK\r\n\r\n")))
