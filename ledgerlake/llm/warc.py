"""WARC archives: written in segments, read back by reassembly.

Each page is an HTTP response in chunked transfer framing. A block longer than ``segment``
bytes is cut: the first record has WARC-Segment-Number 1, continuation records name their
origin by WARC-Segment-Origin-ID, and the last one states WARC-Segment-Total-Length. A page
whose payload equals that of a page with a smaller id is a revisit without a payload.

Archives are text files whose records end in two line breaks, so Spark's own writer makes them
wherever its file systems reach; cuts never split a character. The reader parses whole files.
A record that is complete is decoded where it is read; segments are grouped by origin, ordered
by number, checked for gaps and for the stated length, then decoded. Every payload is checked
against its digest; what doesn't match raises an error.

Rows: a null payload is an empty payload; a null url is an empty one. Rows may repeat: a record's
name holds its place in the writer's task, so equal rows are records of their own; each row with
the group's smallest id is a response. Null ids come last and revisit, unless the whole group
has no id: then all its rows are responses. An empty table gives empty archives. Only the named
columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, scratch, staged

#: Bytes of a record's block, and of a chunk, at most.
SEGMENT, CHUNK = 32 << 10, 8 << 10
#: Records of an archive file at most, about; a file is read as a whole.
FILE_RECORDS = 4000
#: Repeated digests (about 100 bytes each in memory) that are sent to every executor at most.
BROADCAST_ROWS = 200_000
_END = b"\r\n"
_DATE = "2000-01-01T00:00:00Z"  # fixed, so that reruns write equal bytes


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Consecutive parts of at most ``size`` bytes that begin and end between characters."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(p), p) for p in _cuts(payload, size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(_END, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != _END:
            raise ValueError("a chunk doesn't end where its size says")
        parts.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    return head.encode() + block


def _one_line(url: str | None) -> str:
    return "".join(c for c in url or "" if c not in "\r\n")


def records(page_id: int | None, url: str | None, payload: bytes, first: tuple[int | None, int] | None, row: int, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page, of row number ``row``; ``first`` is the page and row that it revisits, if any."""
    own_id = f"<urn:page:{page_id}:{row}>"
    sha = digest(payload)
    fields = [("WARC-Record-ID", own_id), ("WARC-Date", _DATE), ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", f"sha1:{sha}"), ("X-Payload-Length", str(len(payload)))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if first is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record([("WARC-Type", "revisit"), *fields, ("WARC-Profile", profile), ("WARC-Refers-To", f"<urn:page:{first[0]}:{first[1]}>")], http)]
    parts = list(_cuts(http + chunked(payload), segment))
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), *fields], parts[0])]
    out = [_record([("WARC-Type", "response"), *fields, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own_id[:-1]}:{n}>"), ("WARC-Date", _DATE), ("WARC-Segment-Origin-ID", own_id), ("WARC-Segment-Number", str(n))]
        out.append(_record(own + ([("WARC-Segment-Total-Length", str(sum(map(len, parts))))] if n == len(parts) else []), part))
    return out


def parse(archive: bytes | BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, read on one by one."""
    f = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    while line := f.readline():
        if line == _END:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record doesn't begin where the one before ends")
        fields = {}
        while (line := f.readline()) and line != _END:
            name, value = line.decode().removesuffix("\r\n").split(": ", 1)
            fields[name] = value
        size = int(fields["Content-Length"])
        block = f.read(size)
        if len(block) < size:
            raise ValueError("a record is cut short")
        yield fields, block


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[bytes] = []
        columns = [b.column(c) for c in ("page_id", "url", "payload", "row", "first", "first_row")]
        columns[2] = columns[2].cast(pa.binary())
        for page, url, payload, row, first, first_row in zip(*(c.to_pylist() for c in columns), strict=True):
            out += records(page, url, payload or b"", None if first_row is None else (first, first_row), row)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["value"])


def write(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Writes gzip archives of all pages below ``path``.

    Payloads of at least ``least`` bytes that occur again are revisits of their smallest id; they name
    the record of a row with it. Only digests that occur twice or more go into the join
    that finds it: up to ``BROADCAST_ROWS`` of them go to the payloads, which stay where they were read;
    with more, payloads are shuffled by digest. Rows are numbered as they are read.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumns({"sha": F.unhex(F.sha1(F.col("payload").cast("binary"))), "row": F.monotonically_increasing_id()})
    # The smallest id that isn't null, and a row with it.
    again = rows.where(F.octet_length("payload") >= least).groupBy("sha").agg(
        F.min("page_id").alias("smallest"), F.min_by("row", "page_id").alias("smallest_row"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    again = staged(again, "repeated-digests")
    few = again.count() <= BROADCAST_ROWS
    revisits = F.col("smallest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("smallest"))
    rows = rows.join(F.broadcast(again) if few else again, "sha", "left").select(
        "page_id", "url", "payload", "row", F.when(revisits, F.col("smallest")).alias("first"), F.when(revisits, F.col("smallest_row")).alias("first_row")
    )
    # Each record ends in two line breaks: the writer's line separator.
    rows.mapInArrow(_write, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


_RAW = "origin string, number int, total long, record_type string, refers_to string, payload_bytes long, payload_digest string, url string, block binary, whole boolean"


def _decoded(block: bytes, sha: str, size: int) -> bytes:
    head, _, body = block.partition(_END + _END)
    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if digest(payload) != sha or len(payload) != size:
        raise ValueError("a payload doesn't have its digest or length")
    return payload


def _parse(with_payload: bool):
    schema = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("url", pa.string()), ("block", pa.binary()), ("whole", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("content"):
                rows, size = [], 0
                # Unpacked as it is read: a file is some ten MB, a record some KB.
                for fields, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(raw.as_buffer())))):
                    number = int(fields.get("WARC-Segment-Number", 0))
                    row = {"origin": fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]), "number": number, "record_type": fields["WARC-Type"], "whole": not number, "block": block}
                    if total := fields.get("WARC-Segment-Total-Length"):
                        row["total"] = int(total)
                    if number < 2:
                        row |= {"refers_to": fields.get("WARC-Refers-To"), "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "url": fields["WARC-Target-URI"]}
                    if not number:
                        done = _decoded(block, row["payload_digest"], row["payload_bytes"]) if row["record_type"] == "response" else None
                        row["block"] = done if with_payload else None
                    rows.append(row)
                    size += len(row["block"] or b"")
                    if len(rows) == 1000 or size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)
                pa.default_memory_pool().release_unused()

    return run


def _reassemble(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            payloads = []
            for x in b.to_pylist():
                if x["whole"]:
                    payloads.append(x["segments"][0]["block"])
                    continue
                segments = sorted(x["segments"], key=lambda s: s["number"])
                if [s["number"] for s in segments] != list(range(1, len(segments) + 1)) or segments[-1]["total"] is None:
                    raise ValueError(f"segments of {x['origin']} are missing")
                block = b"".join(s["block"] for s in segments)
                if len(block) != segments[-1]["total"]:
                    raise ValueError(f"{x['origin']} doesn't have its total length")
                payload = _decoded(block, x["payload_digest"], x["payload_bytes"])
                payloads.append(payload if with_payload else None)
            kept = [b.column(c) for c in ("origin", "record_type", "refers_to", "payload_bytes", "payload_digest", "url")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(payloads, pa.binary())], names=["origin", "record_type", "refers_to", "payload_bytes", "payload_digest", "url", "payload"])

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """page_id, url, record_type, refers_to (a page_id), payload_bytes, payload_digest, payload of all pages.

    A revisit has no payload; its length and digest are those of what it refers to.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    raw = files.select("content").mapInArrow(_parse(with_payload), _RAW)
    first = lambda c: F.max(F.when(F.col("number") < 2, F.col(c))).alias(c)
    grouped = raw.groupBy("origin").agg(
        first("record_type"), first("refers_to"), first("payload_bytes"), first("payload_digest"), first("url"), F.max("whole").alias("whole"),
        F.collect_list(F.struct("number", "total", "block")).alias("segments"),
    )
    done = grouped.mapInArrow(_reassemble(with_payload), "origin string, record_type string, refers_to string, payload_bytes long, payload_digest string, url string, payload binary")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return done.select(number("origin").alias("page_id"), "url", "record_type", number("refers_to").alias("refers_to"), "payload_bytes", "payload_digest", "payload")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """All pages written to archives in the shared folder and read back, without their payloads."""
    path = scratch(pages.sparkSession, "warc")
    write(pages, path, least)
    return read(pages.sparkSession, path, with_payload=False).drop("payload", "url")
