"""WARC archives: one gzip member per record, written through Spark's committer and read sequentially."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import materialize, scratch

#: Payloads are cut into segments of this size (continuation records), so that a record stays small in memory.
SEGMENT = 8 << 20
#: Records per archive file at most.
RECORDS = 5000
_CHUNK, _BATCH = 1 << 16, 4 << 20
_NAME = "urn:quire:page:"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {re.sub('[\r\n]+', ' ', v)}\r\n" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block)))])
    return gzip.compress(f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n", 4, mtime=0)


def records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, *, date: str = "1970-01-01T00:00:00Z", segment: int = SEGMENT) -> Iterator[bytes]:
    """The gzip members of one capture: a response (with continuations beyond a segment), or a revisit with headers only."""
    name = lambda i: f"<{_NAME}{i}>"
    own = name("none" if page_id is None else page_id)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = [("WARC-Date", date), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")]
    common += [("WARC-Target-URI", url)] if url is not None else []
    if refers_to is not None:
        yield _member([("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", name(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *common], head)
        return
    first, rest = payload[:segment], payload[segment:]
    yield _member([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *([("WARC-Segment-Number", "1")] if rest else [])], head + first)
    for n, at in enumerate(range(0, len(rest), segment), 2):
        last = [("WARC-Segment-Total-Length", str(len(head) + len(payload)))] if at + segment >= len(rest) else []
        yield _member([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{n}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(n)), *last], rest[at : at + segment])


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = 0, segment: int = SEGMENT, per_file: int = RECORDS) -> None:
    """Write one capture per row of ``pages`` to archive files under ``path``.

    Of rows with equal payloads of at least ``min_revisit`` bytes, those with the smallest id are responses and the
    others revisits of it; smaller payloads are all responses. A null payload is empty. A null id comes after
    all others, so its row is a response only if all ids of its payload are null. Rows that repeat both id and
    payload are alike and written each. Other columns play no part; an empty table leaves no records.
    The first of each payload is found by digest and id alone (partial minimum before the shuffle). Only digests seen
    more than once are joined back, so rows of other payloads meet no partner and, where that table is small enough
    for Spark to broadcast, no payload is shuffled; else the adaptive skew join may split a payload of very many rows.
    Spark's text writer puts the members down as they are: the last byte of a member, the highest byte of its
    length, is zero and serves as the line separator. So files appear when their task commits, in any file system.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made, size = [], 0
            for page, url, payload, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                data = payload.as_py()
                members = b"".join(records(page, url, data, first if first != page and len(data) >= min_revisit else None, segment=segment))
                if members[-1]:
                    raise ValueError("a record of 16 MB or more; use smaller segments")
                made.append(members[:-1])  # a capture stays in one file with its continuations
                size += len(members)
                if size >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])
                    made, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    source = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")).withColumn("digest", F.sha1("payload"))
    firsts = materialize(source.select("digest", "id").groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-firsts")
    rows = source.join(firsts, "digest", "left").select("id", "url", "payload", F.coalesce("first", "id").alias("first"))
    rows.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", per_file).text(path)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def read_records(data: memoryview | bytes, chunk: int = _CHUNK) -> Iterator[Record]:
    """The records of an archive, member by member: inflated a chunk at a time, framed by Content-Length, block digests verified."""
    at, view = 0, memoryview(data)
    while at < len(view):
        inflate, out = zlib.decompressobj(31), bytearray()
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("truncated gzip member")
            out += inflate.decompress(view[at : at + chunk])
            at += min(chunk, len(view) - at)
        at -= len(inflate.unused_data)
        end = out.find(b"\r\n\r\n")
        lines = bytes(out[:end]).decode("utf-8", "surrogatepass").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        length = int(headers["Content-Length"])
        block = bytes(out[end + 4 : end + 4 + length])
        if len(block) != length or out[end + 4 + length :] != b"\r\n\r\n":
            raise ValueError("a block that does not fit its Content-Length")
        if headers.get("WARC-Block-Digest", "") != f"sha1:{sha1_base32(block)}":
            raise ValueError("a block that does not fit its digest")
        yield Record(headers, block)


def captures(found: Iterator[Record]) -> Iterator[tuple[int | None, str | None, bytes | None, int, str, str, int | None]]:
    """(page_id, url, payload, payload_bytes, payload_digest, type, refers_to) of a file's records; continuations are joined and payload digests verified."""
    number = lambda s: int(s[len(_NAME) + 1 : -1]) if s[len(_NAME) + 1 : -1].lstrip("-").isdigit() else None

    def finish(first: Record, parts: list[bytes]) -> tuple:
        head, _, start = parts[0].partition(b"\r\n\r\n")
        length = int(re.search(rb"(?m)^Content-Length: (\d+)", head)[1])
        payload, digest = b"".join([start, *parts[1:]]), first.headers["WARC-Payload-Digest"].removeprefix("sha1:")
        kind, url, page = first.headers["WARC-Type"], first.headers.get("WARC-Target-URI"), number(first.headers["WARC-Record-ID"])
        if kind == "revisit":
            return page, url, None, length, digest, kind, number(first.headers["WARC-Refers-To"])
        if len(payload) != length or sha1_base32(payload) != digest:
            raise ValueError("a payload that does not fit its length or digest")
        return page, url, payload, length, digest, kind, None

    first, parts = None, []
    for r in found:
        if r.headers["WARC-Type"] == "continuation":
            if first is None or r.headers["WARC-Segment-Origin-ID"] != first.headers["WARC-Record-ID"] or int(r.headers["WARC-Segment-Number"]) != len(parts) + 1:
                raise ValueError("a continuation out of order")
            parts.append(r.block)
            continue
        if first is not None:
            yield finish(first, parts)
        first, parts = r, [r.block]
    if first is not None:
        yield finish(first, parts)


def read_warc(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of all captures under ``path``.

    Each file is read by one task from first to last record. A record that does not fit its framing or digests fails
    the read. ``payloads=False`` leaves payloads null (they are verified nonetheless); a revisit's payload is null.
    """
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for row in captures(read_records(content.as_buffer())):
                    rows.append(row if payloads else (*row[:2], None, *row[3:]))
                    size += 200 + len(row[2] or b"") * payloads
                    if size >= _BATCH:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op9: what the archives of all pages say of each."""
    path = scratch(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_warc(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to FROM h
"""
