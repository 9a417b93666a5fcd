"""WARC archives: a writer with one gzip member a record, and a reader that splits files anywhere.

Of records with equal payloads (by SHA-1 and length) the one with the largest page_id is a
response, the others revisit it; a revisit keeps the HTTP header of its response, so the length of
the full payload is still known. Files are written by Spark's own writer with its commit protocol,
to any file system: a member's last byte is the high byte of its size, 0 below 16 MB (larger ones
are followed by an empty member), and the text writer adds that byte as its line end.

A reading task scans a byte range for gzip magic, takes a candidate for a member only if its
beginning inflates to a WARC header, and owns the records that start inside its range; the last of
them is read beyond the range's end.

Defined results: null html is an empty payload and takes part in the grouping like any other; null
url leaves out the target header; a null page_id is never the largest, unless all of a group are
null; rows repeated with the largest page_id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm.scratch import Scratch, open_file, shuffles_removed

MAGIC = b"\x1f\x8b\x08"
RANGE = 4 << 20
LOOK = 1 << 16
TASKS = 10_000
LEVEL = 3
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def member(page_id: int | None, url: str | None, html: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record as a gzip member, without the zero byte that ends it."""
    payload = html.encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()
    if out[-1]:
        empty = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += empty.compress(b"") + empty.flush()
    return out[:-1]


def write_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            rows = batch.slice(a, 256).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([member(r["page_id"], r["url"], r["html"], r["top"], r["revisit"]) for r in rows], pa.binary())], ["member"])


def write_archives(pages: DataFrame, folder: str, scratch: Scratch) -> None:
    """Archives of all pages in ``folder``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    groups = scratch.save(keyed.groupBy("sha", "size").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "groups")
    joined = keyed.join(groups, ["sha", "size"], "left").withColumn("revisit", F.coalesce(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.lit(False)))
    members = joined.select("page_id", "url", "html", "top", "revisit").mapInArrow(write_rows, "member binary")
    with shuffles_removed(pages.sparkSession):
        members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)
    scratch.drop("groups")


def starts_record(raw: bytes) -> bool:
    """Whether a member that begins here inflates to a WARC header."""
    try:
        return zlib.decompressobj(31).decompress(raw, 8).startswith(b"WARC/1.")
    except zlib.error:
        return False


def scan(file, start: int, end: int) -> Iterator[bytes]:
    """Inflated records whose members begin in [start, end)."""
    file.seek(start)
    buf, base = file.read(end - start + LOOK), start
    at = 0
    while True:
        at = buf.find(MAGIC, at)
        if at < 0 or base + at >= end:
            return
        if not starts_record(buf[at : at + LOOK]):
            at += 1
            continue
        inflate, out, used = zlib.decompressobj(31), [], at
        while True:
            out.append(inflate.decompress(buf[used:]))
            if inflate.eof:
                at = len(buf) - len(inflate.unused_data)
                break
            more = file.read(RANGE)
            if not more:
                raise ValueError("a record is cut short")
            buf, base, used = more, base + len(buf), 0
        yield b"".join(out)


def parse(record: bytes) -> tuple:
    """A row of RECORDS from one record; a response's digest is checked against its payload."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest, kind = fields["WARC-Payload-Digest"][5:], fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("payload and digest differ")
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None  # noqa: E731  <urn:page:N>
    return number(fields["WARC-Record-ID"]), size, digest, kind, number(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI")


def read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    for batch in batches:
        for r in batch.to_pylist():
            with open_file(r["path"]) as file:
                rows = [parse(x) for x in scan(file, r["start"], r["end"])]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_archives(spark: SparkSession, folder: str, size: int = RANGE) -> DataFrame:
    """Every record of the folder's archives, read by byte ranges of ``size``."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "length")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start"), "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))
    ranges = ranges.repartition(max(1, min(ranges.count(), TASKS)), "path", "start")  # a count that is given is not coalesced
    return ranges.mapInArrow(read_rows, RECORDS)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch.path("archives"), scratch)
    return read_archives(spark, scratch.path("archives")).drop("url")
