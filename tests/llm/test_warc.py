"""Archives: exact round trips, revisits against grouping in Python, and
transactions assembled from either direction of the identifiers."""

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tessera.llm import warc as W
from tessera.llm.common import shared_path

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    """Per page in id order, with the first of repeated rows first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first = {}
    out = []
    for i in order:
        page, html = rows[i][0], rows[i][2] or ""
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if html not in first:
            first[html] = page
            out.append((page, len(data), digest, "response", None))
        else:
            out.append((page, len(data), digest, "revisit", first[html]))
    return out


ROWS = [
    (5, "http://a.example/x?y=1", "<p>é same</p>"), (2, "http://b.example", "<p>é same</p>"), (9, None, "<p>é same</p>"),
    (3, "http://a.example/\r\nX-Evil: 1", ""), (4, "http://a.example/日本", None), (7, "", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"),
    (8, "u", "x" * 300_000), (8, "u", "x" * 300_000), (None, "n", "alone"), (None, "n", "<p>é same</p>"), (8, "u", "other"),
]


def test_report_matches_grouping(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"sha": F.lit(1), "record_type": F.lit("own")}).repartition(4)
    got = sorted((tuple(r) for r in W.archive_report(df).collect()), key=str)
    assert got == sorted(brute(ROWS), key=str)
    assert W.archive_report(df.limit(0)).count() == 0


def test_payloads_and_transactions(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = shared_path(spark, "warc-test")
    files = W.write_archives(df, path)
    assert sum(r.n_records for r in files.collect()) == 3 * len(ROWS)
    found = W.captures(W.records(files, path)).collect()
    assert len(found) == len(ROWS) == len({r.record_id for r in found})
    given = {i: h for i, _, h in ROWS if h}
    for r in found:
        assert len(r.requests) == len(r.metadata) == 1
        page = r.metadata[0].fields.get("page-id")
        if r.record_type == "response" and page not in (None, "8"):
            assert bytes(r.payload).decode() == given.get(int(page), "")
        if r.record_type == "revisit":
            assert r.payload is None and r.refers_to in {x.record_id for x in found if x.record_type == "response"}
    assert not any("evil" in k.lower() for r in found for k in r.asDict())


def test_each_record_is_a_gzip_member():
    data = W.transaction(1, "http://h/p?q", b"body", 0, None, "2020-01-01T00:00:00Z")
    with gzip.open(io.BytesIO(data)) as f:
        parsed = list(W.parse(f))
    assert [dict(h)["warc-type"] for h, _ in parsed] == ["request", "response", "metadata"]
    assert parsed[0][1] == b"GET /p?q HTTP/1.1\r\nHost: h\r\n\r\n" and parsed[1][1].endswith(b"\r\n\r\nbody")
    assert data.count(b"\x1f\x8b\x08") >= 3


def test_other_archives(spark, tmp_path):
    """Plain, a folded header, links from the capture, two metadata records,
    and a capture of no transaction."""
    def rec(headers, block=b""):
        return b"WARC/1.0\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"

    data = rec([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<i>")], b"software: x\r\n")
    data += rec([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("WARC-Concurrent-To", "<q>"), ("X", "1\r\n folded"),
                 ("Content-Type", "application/http")], b"HTTP/1.1 200 OK\r\n\r\nhello")
    data += rec([("WARC-Type", "request"), ("WARC-Record-ID", "<q>"), ("Content-Type", "application/http")], b"GET / HTTP/1.1\r\n\r\n")
    for k in "mn":
        data += rec([("WARC-Type", "metadata"), ("WARC-Record-ID", f"<{k}>"), ("WARC-Concurrent-To", "<a>"),
                     ("Content-Type", "application/warc-fields")], b"key: v\r\n")
    data += rec([("WARC-Type", "response"), ("WARC-Record-ID", "<b>"), ("Content-Type", "text/plain")], b"bare")
    (tmp_path / "x.warc").write_bytes(data)
    files = spark.createDataFrame([(str(tmp_path / "x.warc"),)], "file string")
    got = {r.record_id: r for r in W.captures(W.records(files, f"file://{tmp_path}")).collect()}
    assert set(got) == {"<a>", "<b>"}
    assert bytes(got["<a>"].payload) == b"hello" and bytes(got["<b>"].payload) == b"bare"
    assert [x.record_id for x in got["<a>"].requests] == ["<q>"]
    assert sorted(x.record_id for x in got["<a>"].metadata) == ["<m>", "<n>"] and got["<b>"].metadata is None


def test_broken_archive_is_refused():
    with pytest.raises(ValueError):
        list(W.parse(io.BytesIO(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nabc")))
    with pytest.raises(ValueError):
        list(W.parse(io.BytesIO(b"hello\r\n")))
