"""WARC archives: written from pages, and captures assembled from them.

A page becomes a request, a response (or revisit) and a metadata record; the
first and last name the second in ``WARC-Concurrent-To``, and the page's id
stands in the metadata record only. Of pages with equal payloads (SHA-1 and
length) the one with the smallest id has the response, the others revisit
it. Every record is a gzip member of its own.

``records`` reads archives, plain or compressed, by streaming; ``captures``
joins the records of a transaction through the concurrent-to identifiers,
whichever record names the other, to one nested row per capture.

Pages are dealt by ranges of their id, so repeated rows meet in one task. A
task names its files after its attempt; only the rows of tasks that
succeeded name files, so a repeated task leaves at most an unused file.

Defined results: a null html is an empty payload; a null url becomes
``urn:page:<id>``; of repeated rows the first is as without the others and
the rest revisit; a null id is larger than all others; empty tables give no
archive and no capture; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import require, shared_path, stored

VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 1 << 30  # a file is closed beyond these
BATCH_BYTES = 16 << 20  # of payloads in a batch of records
CAPTURES = ("response", "revisit")

RECORD = (
    "record_id string, record_type string, target_uri string, date string, content_type string, concurrent_to array<string>, "
    "refers_to string, declared_digest string, fields map<string,string>, payload_bytes long, payload_digest string, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(kind: str, page_id: int | None, digest: str, repeat: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{page_id}/{digest}/{repeat}').urn}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + member.flush()


def transaction(page_id: int | None, url: str | None, payload: bytes, repeat: int, refers_to: tuple[int | None] | None, date: str) -> bytes:
    """The three records of a page. ``refers_to`` holds the id of the page
    whose response it revisits."""
    digest = payload_digest(payload)
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
    parts = urlsplit(uri)
    capture = record_id("capture", page_id, digest, repeat)
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    target = f"{parts.path or '/'}{'?' + parts.query if parts.query else ''}"
    request = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, digest, repeat)), *common,
         ("WARC-Concurrent-To", capture), ("Content-Type", "application/http; msgtype=request")],
        f"GET {target} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n".encode(),
    )
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", capture), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        response = _record([("WARC-Type", "response"), *headers], head + payload)
    else:
        original = record_id("capture", refers_to[0], digest, 0)
        response = _record([("WARC-Type", "revisit"), *headers, ("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", original)], head)
    fields = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    metadata = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, digest, repeat)), *common,
         ("WARC-Concurrent-To", capture), ("Content-Type", "application/warc-fields")],
        fields,
    )
    return request + response + metadata


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives under ``path`` and returns their names (``file``)
    and numbers of records. ``date`` is the capture time of all records."""
    require(pages, ["page_id", "url", "html"])
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns({"sha": F.sha1("html"), "size": F.octet_length("html")})
    shared = (
        rows.groupBy("sha", "size").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1").select("sha", "size", "first_id", F.lit(True).alias("shared"))
    )
    ordered = (
        rows.join(stored(shared, "warc-shared"), ["sha", "size"], "left")
        .select("page_id", "url", "html", "sha", "first_id", "shared")
        .repartitionByRange(F.col("page_id").asc_nulls_last())
        .sortWithinPartitions(F.col("page_id").asc_nulls_last(), "sha")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        out, name, size, n, k = None, "", 0, 0, 0
        last, repeat = None, 0
        for b in batches:
            for page_id, url, html, sha, first_id, is_shared in zip(*(b.column(i).to_pylist() for i in range(6))):
                repeat = repeat + 1 if last == (page_id, sha) else 0
                last = (page_id, sha)
                original = repeat == 0 and page_id == first_id
                data = transaction(
                    page_id, url, html.encode("utf-8", "surrogatepass"), repeat,
                    (first_id,) if is_shared and not original else None, date,
                )
                if out is None:
                    name = f"{folder}/pages-{part:06d}-{k:04d}-{attempt}.warc.gz"
                    out = files.open_output_stream(name, compression=None)
                out.write(data)
                size, n = size + len(data), n + 3
                if size > FILE_BYTES:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"file": name, "n_records": n}])
                    out, size, n, k = None, 0, 0, k + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "n_records": n}])

    return stored(ordered.mapInArrow(run, "file string, n_records long"), "warc-files")


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers (names in lower case) and block of each record of a plain
    archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and headers:  # a folded line
                headers[-1] = (headers[-1][0], f"{headers[-1][1]} {text.strip()}")
                continue
            name, _, value = text.partition(":")
            headers.append((name.strip().lower(), value.strip()))
        size = int(dict(headers).get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def _row(headers: list[tuple[str, str]], block: bytes, with_payload: bool) -> dict:
    one = dict(headers)
    kind, content = one.get("warc-type"), one.get("content-type", "")
    payload = block
    if content.startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    fields = {}
    if content.startswith("application/warc-fields"):
        for line in block.decode("utf-8", "replace").splitlines():
            name, colon, value = line.partition(":")
            if colon:
                fields[name.strip().lower()] = value.strip()
    has_payload = kind != "revisit"
    return {
        "record_id": one.get("warc-record-id"), "record_type": kind, "target_uri": one.get("warc-target-uri"), "date": one.get("warc-date"),
        "content_type": content, "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
        "refers_to": one.get("warc-refers-to"), "declared_digest": one.get("warc-payload-digest"), "fields": list(fields.items()),
        "payload_bytes": len(payload) if has_payload else None, "payload_digest": payload_digest(payload) if has_payload else None,
        "payload": payload if has_payload and with_payload else None,
    }


def records(files: DataFrame, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives named in ``file``. Digest and size
    are those of the payload read; a revisit has neither."""
    n = files.count()
    cores = files.sparkSession.sparkContext.defaultParallelism
    dealt = files.select("file").repartition(max(1, min(n, 1000 * cores)))
    kind = pa.schema([
        *((c, pa.string()) for c in ("record_id", "record_type", "target_uri", "date", "content_type")),
        ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("declared_digest", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_file(name) as raw:
                    packed = raw.read(2) == b"\x1f\x8b"
                    raw.seek(0)
                    rows, size = [], 0
                    for headers, block in parse(gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw)):
                        rows.append(_row(headers, block, with_payload))
                        size += 1000 + (len(block) if with_payload else 0)
                        if size > BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=kind)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return dealt.mapInArrow(run, RECORD)


def _part(kind: str) -> Column:
    return F.struct("record_id", "target_uri", "date", "content_type", "fields", "payload_bytes", "payload_digest", "payload").alias(kind)


def captures(found: DataFrame) -> DataFrame:
    """One row per response or revisit record: its columns, and ``requests``
    and ``metadata``, the records of its transaction by identifier (a
    capture has few). They are null for a capture without others."""
    kept = found.filter(F.col("record_type").isin(*CAPTURES))
    others = found.filter(F.col("record_type").isin("request", "metadata"))
    named = others.select(F.explode("concurrent_to").alias("capture_id"), F.col("record_id").alias("other_id"))
    naming = kept.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other_id"))
    links = named.unionByName(naming).distinct()
    joined = links.join(others.select(F.col("record_id").alias("other_id"), "record_type", _part("part")), "other_id")
    of_kind = lambda kind: F.array_sort(F.collect_list(F.when(F.col("record_type") == kind, F.col("part").dropFields("fields"))))
    grouped = joined.groupBy("capture_id").agg(
        of_kind("request").alias("requests"),
        F.collect_list(F.when(F.col("record_type") == "metadata", F.col("part"))).alias("metadata"),
    )
    return kept.drop("concurrent_to", "fields").join(grouped, kept["record_id"] == grouped["capture_id"], "left").drop("capture_id")


def archive_report(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back
    and gives a row per capture, a revisit's size and digest from the
    response that it names."""
    spark: SparkSession = pages.sparkSession
    path = shared_path(spark, "warc")
    read = stored(records(write_archives(pages, path), path, with_payload=False), "warc-records")
    found = stored(captures(read).select(
        "record_id", "record_type", "refers_to", "payload_bytes", "payload_digest",
        F.get(F.col("metadata"), F.lit(0))["fields"]["page-id"].cast("long").alias("page_id"),
    ), "warc-captures")
    originals = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("original_id"),
        F.col("payload_bytes").alias("original_bytes"), F.col("payload_digest").alias("original_digest"),
    )
    return found.join(originals, "refers_to", "left").select(
        "page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "original_digest").alias("payload_digest"), "record_type", F.col("original_id").alias("refers_to"),
    )
