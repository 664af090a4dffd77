"""WARC archives: write with an index first, read selected records by coalesced byte ranges.

Writing gives one index row per record (file, offset, length, URL, digest), and
the index is a table of its own. Reading starts from index rows: a window per
file joins neighbouring records into ranges of bounded size, and each range is
one read. Records are gzip members, so that each can be inflated alone.

Of the records with an equal payload of `least` bytes or more, the one with the
smallest page_id is written whole (`response`), the others as `revisit`s.

* null html: an empty payload. null url: a record without a target URI; the
  index keeps null. Line breaks in a URL are percent-encoded in the archive.
* null page_id: always a response (no order tells it from its copies).
* Repeated rows (same page_id and payload): all of them responses, as neither
  has the smaller id. An empty table: an empty index.
* Extra columns are ignored.

Files of tasks that were repeated or lost stay unread: only the index names
the files that count.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read, scratch_path, slices, table

DATE = "2024-01-01T00:00:00Z"
SALTS = 16
INDEX = "page_id long, url string, digest string, payload_bytes long, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{digest}')}>", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header fields, HTTP header fields and body of one record."""

    def fields(head: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in head.decode().split("\r\n")[1:] if ":" in x)}

    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return warc, fields(http), body


def write_archives(pages: DataFrame, path: str, least: int = 0, file_bytes: int = 64 << 20) -> DataFrame:
    """Write a record per row of pages(page_id, url, html) below path; the index."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumns({"sha": F.sha1(F.encode("html", "UTF-8")), "n": F.octet_length("html")})
    # One payload may be that of a third of all pages: its stubs are dealt out by salt, and its one row goes to each.
    stub = pages.select("page_id", "sha", "n", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    first = stub.filter(F.col("n") >= least).groupBy("sha", "n").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("refers_to < last")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    revisits = stub.join(first, ["sha", "n", "salt"]).filter("page_id > refers_to").select("page_id", "sha", "refers_to").distinct()
    rows = pages.join(revisits, ["page_id", "sha"], "left").select("page_id", "url", "html", "sha", "refers_to")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for b in slices(batches, "html", 8 << 20):
                done = []
                for page_id, url, html, sha, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    payload = html.encode()
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    z = zlib.compressobj(1, zlib.DEFLATED, 31)
                    raw = z.compress(record(page_id, url, payload, digest, refers_to)) + z.flush()
                    out.write(raw)
                    done.append((page_id, url, digest, len(payload), "response" if refers_to is None else "revisit", refers_to, name, at, len(raw)))
                    at += len(raw)
                names = [x.split(" ")[0] for x in INDEX.split(", ")]
                kinds = {"long": pa.int64(), "string": pa.string()}
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k.split(" ")[1]]) for c, k in zip(zip(*done, strict=True), INDEX.split(", "), strict=True)], names)
        finally:
            if out is not None:
                out.close()

    # The index must name the files of the tasks that were kept: it is written once.
    return table(rows.mapInArrow(put, INDEX), "warc-index")


def ranges(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """Index rows to (file, at, to, parts): sorted records less than `gap` apart, in reads of about `most` bytes."""
    w = W.partitionBy("file").orderBy("offset", "length")
    end = F.col("offset") + F.col("length")
    new = (F.col("offset") - F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1)) > gap) | (F.floor(F.col("offset") / most) != F.floor(F.lag("offset").over(w) / most))
    marked = index.select("file", "offset", "length", F.coalesce(new, F.lit(True)).cast("int").alias("new"))
    marked = marked.withColumn("range", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy("file", "range").agg(F.min("offset").alias("at"), F.max(end).alias("to"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("parts")).drop("range")


def read_records(index: DataFrame, path: str, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """The records that index rows name, read from the archives and checked against their digests."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        for b in batches:
            for file, at, to, parts in zip(*(b.column(k).to_pylist() for k in ("file", "at", "to", "parts")), strict=True):
                with fs.open_input_file(f"{root}/{file}") as f:
                    f.seek(at)
                    data = f.read(to - at)
                found = []
                for p in parts:
                    begin = p["offset"] - at
                    warc, http, body = parse(zlib.decompress(data[begin : begin + p["length"]], 31))
                    digest = warc["warc-payload-digest"].removeprefix("sha1:")
                    number = lambda k: int(warc[k]) if k in warc else None  # noqa: E731, B023
                    if warc["warc-type"] == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"{file} at {p['offset']}: the payload does not fit its digest")
                    size = len(body) if warc["warc-type"] == "response" else int(http["content-length"])
                    found.append((number("x-page-id"), size, digest, warc["warc-type"], number("x-refers-to-page-id"), warc.get("warc-target-uri")))
                names = [x.split(" ")[0] for x in RECORD.split(", ")]
                kinds = {"long": pa.int64(), "string": pa.string()}
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k.split(" ")[1]]) for c, k in zip(zip(*found, strict=True), RECORD.split(", "), strict=True)], names)

    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges(index, gap, most).repartition(n).mapInArrow(get, RECORD)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    index = write_archives(read(spark, sf_dir, "pages"), path)
    return read_records(index, path)
