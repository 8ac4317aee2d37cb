"""WARC archives: written, read back, and assembled into one nested row for each capture.

Writing: a page becomes a transaction of three records, request, response (or revisit) and metadata; the request and the
metadata name the response's record id in WARC-Concurrent-To. Each task writes a file of gzip members, one a record; the
manifest names the files of finished tasks, so what a lost executor left does not count. Which pages are revisits is settled
before: payloads are grouped by SHA-256 with map-side aggregation, and only the digests that repeat are written and joined back, in
a join that adaptive execution splits where one payload is hot.

Reading: files are parsed record by record. Transactions are assembled by joins through the concurrent-to ids. Responses are then
complete; only revisits are joined, with the captures that they refer to, by record id.

Defined results: null html is an empty payload, a null url is ``about:blank``. Payloads below ``LEAST_REVISITED`` bytes are always responses. Of equal
longer ones the smallest non-null page_id is the response; its repeated rows are too. Rows that repeat both page_id and payload
have equal record ids and are paired by rank. A null page_id is carried as null. An empty table writes no file and gives an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, shared_dir, shuffle_partitions

LEAST_REVISITED = 100
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(kind: str, page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{kind} {page_id} {digest}'.encode()).digest()[:16], version=4)}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def transaction(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> list[bytes]:
    target = quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~-._")
    parts = urlsplit(target)
    own = record_id("response", page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    main = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        main += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id("response", first, digest))]
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    ask = f"GET {path} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n".encode()
    fields = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    return [
        record([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, digest)), *common, ("WARC-Concurrent-To", own), ("Content-Type", "application/http;msgtype=request")], ask),
        record(main, http if revisit else http + payload),
        record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, digest)), *common, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], fields),
    ]


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed stream; holds one record at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        name = None
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            if line[:1] in b" \t" and name:
                headers[name] += " " + line.strip().decode()
            else:
                name, _, value = line.decode().partition(":")
                name = name.strip().lower()
                headers[name] = value.strip()
        if "content-length" not in headers:
            raise ValueError("a record without its length")
        block = stream.read(int(headers["content-length"]))
        if len(block) < int(headers["content-length"]):
            raise ValueError("a record is cut short")
        yield headers, block


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives below ``folder`` (a URI that all executors reach) and return the manifest: path, pages."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= LEAST_REVISITED
    first = rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Written, so that the join has two bare exchanges and adaptive execution can split a payload that very many pages share.
    rows = rows.join(cut(first, "firsts"), "digest", "left").select("page_id", "url", "payload", "digest", "first")

    def write_part(batches):
        sink, path, n = None, None, 0
        for batch in batches:
            for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
                    fs, at = pa.fs.FileSystem.from_uri(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(at, compression=None)
                revisit = first is not None and first != page_id
                for one in transaction(page_id, url, html, digest, first, revisit):
                    sink.write(gzip.compress(one, LEVEL, mtime=0))
                n += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "pages": [n]})

    return cut(rows.mapInArrow(write_part, "path string, pages long"), "manifest")


FIELDS = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string, http_length long, payload binary, path string, place long"


def read_back(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A row for each record in the archives. payload: what follows the HTTP header of a response, the block of others; http_length: the length that an HTTP header states."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [pa.string()] * 7 + [pa.int64(), pa.binary(), pa.string(), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def read_part(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = pa.fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with fs.open_input_stream(at, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) as stream:
                    for place, (h, block) in enumerate(records(stream)):
                        length, payload = None, block
                        if h.get("content-type", "").startswith("application/http") and h["warc-type"] != "request":
                            head, _, payload = block.partition(b"\r\n\r\n")
                            stated = [x.split(b":", 1)[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                            length = int(stated[0]) if stated else None
                        rows.append((h["warc-type"], h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-payload-digest"), length, payload, path, place))
                        size += len(payload)
                        if size > 16 << 20 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return manifest.select("path").repartition(shuffle_partitions(spark), "path").mapInArrow(read_part, FIELDS)


def assemble(found: DataFrame) -> DataFrame:
    """capture_id, target_uri, date, and the structs response, request and metadata: a row for each capture. ``found`` (records; may lack columns) is read more than once, so a written table."""
    own = [c for c in found.columns if c not in ("concurrent_to", "path", "place")]

    def of(kind, key, name):
        rank = F.row_number().over(Window.partitionBy(key).orderBy("path", "place"))
        rows = found.where(kind).select(F.col(key).alias("capture_id"), rank.alias("rank"), F.struct(*own).alias(name))
        return rows

    response = of(F.col("type").isin("response", "revisit"), "record_id", "response")
    request = of(F.col("type") == "request", "concurrent_to", "request")
    metadata = of(F.col("type") == "metadata", "concurrent_to", "metadata")
    joined = response.join(request, ["capture_id", "rank"], "left").join(metadata, ["capture_id", "rank"], "left")
    return joined.select("capture_id", "response.target_uri", "response.date", "response", "request", "metadata")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: a row for each page, from the archives alone."""
    spark = pages.sparkSession
    found = read_back(spark, write(pages, folder or f"{shared_dir(spark)}/warc"))
    # The digest and the length are those of the stored payload; a page's own id is in its metadata. Payloads need not travel on.
    held = found.withColumn("stored_digest", F.when(F.col("type") == "response", F.sha2("payload", 256)))
    held = held.withColumn("stored_bytes", F.when(F.col("type") == "response", F.octet_length("payload").cast("long")))
    held = held.withColumn("payload", F.when(F.col("type") == "metadata", F.col("payload")))
    captures = assemble(cut(held, "records"))
    page_id = F.regexp_extract(F.col("metadata.payload").cast("string"), r"page-id: (-?\d*)", 1)
    captures = captures.select(
        "capture_id",
        F.nullif(page_id, F.lit("")).cast("long").alias("page_id"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("original"),
        F.col("response.stored_bytes").alias("payload_bytes"),
        F.col("response.stored_digest").alias("payload_digest"),
    )
    captures = cut(captures, "captures")
    own = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = captures.where("record_type = 'response'").select(*own, F.lit(None).cast("long").alias("refers_to"))
    revisits = captures.where("record_type = 'revisit'").select("page_id", "original", "record_type")
    # Equal captures repeat their id; one row for each is enough to be referred to. Written, so that a hot one can be split.
    originals = captures.where("record_type = 'response'").groupBy(F.col("capture_id").alias("original")).agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest"))
    originals = cut(originals.join(revisits.select("original").distinct(), "original", "left_semi"), "originals")
    return responses.unionByName(revisits.join(originals, "original", "left").select(*own, "refers_to"))
