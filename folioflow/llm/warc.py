"""WARC reading with segment reassembly, and writing (operator 10).

Files are read into records. Records of one segment are decoded where they are read. Segmented ones are grouped by the
identifier of their origin, ordered by segment number and joined as they stream by, so a task holds one of them at a
time. The joined length must be the total that the last segment states. The block of a response is an HTTP message, of
which chunked transfer framing and compression are decoded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.shared import readable

#: Bytes of a block in a written segment, and of a chunk of its body.
SEGMENT_BYTES = 2048
CHUNK_BYTES = 1000

_GZIP = b"\x1f\x8b\x08"
#: Bytes that are given to the decompressor at a time.
_STEP = 16 << 10

_RECORDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("origin_id", pa.string()),
        ("type", pa.string()),
        ("uri", pa.string()),
        ("date", pa.string()),
        ("segment", pa.int32()),
        ("total", pa.int64()),
        ("page", pa.string()),
        ("block", pa.binary()),
        ("truncated", pa.bool_()),
    ]
)
RECORDS = "record_id string, origin_id string, type string, uri string, date string, segment int, total bigint, page string, block binary, truncated boolean"
RESPONSES = "record_id string, uri string, date string, page string, n_segments int, http_status int, state string, body binary"
_RESPONSES = pa.schema(
    [
        ("record_id", pa.string()),
        ("uri", pa.string()),
        ("date", pa.string()),
        ("page", pa.string()),
        ("n_segments", pa.int32()),
        ("http_status", pa.int32()),
        ("state", pa.string()),
        ("body", pa.binary()),
    ]
)


def members(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """data unpacked: each of its gzip members, or itself where it isn't compressed, and whether it is whole.

    Of a broken member comes what could be unpacked; the next one is looked for behind the place that broke.
    """
    if data[:2] != _GZIP[:2]:
        yield data, True
        return
    view, at = memoryview(data), 0
    while 0 <= at < len(data):
        one, out, whole = zlib.decompressobj(31), [], True
        try:
            while not one.eof and at < len(data):
                part = view[at : at + _STEP]
                out.append(one.decompress(part))
                at += len(part) - len(one.unused_data)
        except zlib.error:
            at += 1
        if not one.eof:
            whole = False
        yield b"".join(out), whole
        at = data.find(_GZIP, at)


def _number(s: str | None) -> int | None:
    return int(s) if s and s.isascii() and s.isdigit() and len(s) < 19 else None


def parse(data: bytes) -> Iterator[dict]:
    """The records of a file. Bytes that are no record are skipped up to the next one. A gzip member that breaks between
    records, or in a header, gives a record of type broken member; one that breaks in a block has it marked truncated."""
    for part, whole in members(data):
        at, told = 0, whole
        while (at := part.find(b"WARC/", at)) >= 0:
            end = part.find(b"\r\n\r\n", at)
            if end < 0:
                break
            head = part[at:end].decode("utf-8", "replace").split("\r\n")
            fields = {}
            for line in head[1:]:
                name, _, value = line.partition(":")
                fields[name.strip().lower()] = value.strip()
            n = _number(fields.get("content-length"))
            if n is None or not re.fullmatch(r"WARC/\d+\.\d+", head[0]):
                at += 5
                continue
            block = part[end + 4 : end + 4 + n]
            kind = fields.get("warc-type", "").lower()
            yield {
                "record_id": fields.get("warc-record-id"),
                "origin_id": fields.get("warc-segment-origin-id") if kind == "continuation" else fields.get("warc-record-id"),
                "type": kind,
                "uri": fields.get("warc-target-uri"),
                "date": fields.get("warc-date"),
                "segment": _number(fields.get("warc-segment-number")),
                "total": _number(fields.get("warc-segment-total-length")),
                "page": fields.get("x-page-id"),
                "block": block,
                "truncated": len(block) < n,
            }
            told |= len(block) < n
            at = end + 4 + n
        if not told:
            yield dict.fromkeys(_RECORDS.names) | {"type": "broken member", "block": b"", "truncated": True}


def dechunked(body: bytes) -> bytes | None:
    """body without chunked transfer framing; None where the framing is broken. Extensions and trailers are dropped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n = int(size, 16)
        if not n:
            return b"".join(out)
        if body[end + 2 + n : end + 4 + n] != b"\r\n":
            return None
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def decoded(block: bytes) -> tuple[int | None, str, bytes | None]:
    """(status, state, body) of an HTTP response."""
    head, found, body = block.partition(b"\r\n\r\n")
    m = re.match(rb"HTTP/\d(?:\.\d)?[ \t]+(\d{3})", head)
    if not m or not found:
        return None, "no http response", None
    status = int(m[1])
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if b"chunked" in fields.get(b"transfer-encoding", b""):
        body = dechunked(body)
        if body is None:
            return status, "broken chunk", None
    if fields.get(b"content-encoding") in (b"gzip", b"x-gzip", b"deflate"):
        try:
            body = zlib.decompress(body, 47)
        except zlib.error:
            return status, "broken compression", None
    return status, "complete", body


def joined(segments: list[dict]) -> tuple[str, bytes | None]:
    """(state, block) of the segments of one record, ordered by number. Repeated segments count once."""
    parts: dict[int, bytes] = {}
    total = None
    for s in segments:
        n = s["segment"] or 1
        if s["truncated"]:
            return "truncated", None
        if n in parts and parts[n] != s["block"]:
            return "conflicting segments", None
        parts[n] = s["block"]
        if s["total"] is not None:
            if total not in (None, s["total"]):
                return "conflicting segments", None
            total = s["total"]
    if sorted(parts) != list(range(1, len(parts) + 1)):
        return "missing segment", None
    if total is None and (len(parts) > 1 or segments[0]["segment"]):
        return "missing segment", None
    block = b"".join(parts[n] for n in sorted(parts))
    if total is not None and len(block) != total:
        return "wrong length" if len(block) > total else "missing segment", None
    return "complete", block


def _response(segments: list[dict]) -> dict:
    state, block = joined(segments)
    status, body = None, None
    if block is not None:
        status, state, body = decoded(block)
    first = segments[0]
    numbers = {s["segment"] or 1 for s in segments}
    return {"record_id": first["origin_id"], **{k: first[k] for k in ("uri", "date", "page")}, "n_segments": len(numbers), "http_status": status, "state": state, "body": body}


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            rows, size = [], 0
            for row in parse(data or b""):
                rows.append(row)
                size += len(row["block"])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_response([r]) for r in batch.to_pylist()], _RESPONSES)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by origin and segment."""
    group: list[dict] = []
    done: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            if group and row["origin_id"] != group[0]["origin_id"]:
                done.append(_response(group))
                size += len(done[-1]["body"] or b"")
                group = []
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(done, _RESPONSES)
                    done, size = [], 0
            group.append(row)
    if group:
        done.append(_response(group))
    if done:
        yield pa.RecordBatch.from_pylist(done, _RESPONSES)


def records(files: DataFrame, content: str = "content") -> DataFrame:
    """The records of WARC files, a row of files each, plain or compressed. A null or empty file has none; bytes between
    records are skipped; a record that its file cuts short is marked truncated."""
    return files.select(F.col(f"`{content}`")).mapInArrow(_parsed, RECORDS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files at path, which may be a folder or a pattern. A file is read by one task, and has to
    fit Spark's limit on a binary value, 2 GB."""
    return records(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content"))


def responses(records: DataFrame) -> DataFrame:
    """(record_id, uri, date, page, n_segments, http_status, state, body): a row for each response record, reassembled.

    state is complete, or why there is no body: missing segment (also where the last, which states the total, is
    missing), wrong length, conflicting segments, truncated, no http response, broken chunk, broken compression.
    Segments are joined by number wherever they are; repeated equal ones count once. Continuations whose first segment is
    missing give a row too. A segment without an origin is incomplete by itself. Other types of records are left out; no
    records give no rows.
    """
    kinds = records.where("type in ('response', 'continuation')")
    alone = kinds.where("type = 'response' and segment is null")
    parts = kinds.where("type = 'continuation' or segment is not null")
    parts = parts.withColumn("origin_id", F.coalesce("origin_id", F.concat(F.lit("none:"), F.coalesce("record_id", F.lit("")))))
    # By size of the data, not by a fixed number: AQE splits and merges this shuffle's partitions where it may.
    moved = parts.repartition("origin_id").sortWithinPartitions("origin_id", "segment")
    return alone.mapInArrow(_single, RESPONSES).unionByName(moved.mapInArrow(_grouped, RESPONSES))


def _record(kind: str, ident: str, block: bytes, **fields) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in (body[i : i + size] for i in range(0, len(body), size))) + b"0\r\n\r\n"


def response(ident: str, uri: str | None, body: bytes, page: object = None, segment: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of a response with a chunked body, in segments of so many bytes."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    fields = {"WARC_Target_URI": uri, "WARC_Date": "2024-01-01T00:00:00Z", "X_Page_ID": page, "Content_Type": "application/http;msgtype=response"}
    if len(parts) == 1:
        return [_record("response", ident, block, **fields)]
    out = [_record("response", ident, parts[0], WARC_Segment_Number=1, **fields)]
    for n, part in enumerate(parts[1:], 2):
        last = {"WARC_Segment_Total_Length": len(block)} if n == len(parts) else {}
        out.append(_record("continuation", f"{ident[:-1]}:{n}>", part, WARC_Segment_Origin_ID=ident, WARC_Segment_Number=n, **last))
    return out


def _zipped(record: bytes) -> bytes:
    one = zlib.compressobj(1, wbits=31)
    return one.compress(record) + one.flush()


def _written(segment: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two files for each batch: what comes first of each response, plain; and in the reverse order what continues them,
    each record a gzip member."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        first, more = [], []
        for page, uri, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
            made = response(f"<urn:x-page:{part}-{at}>", uri, (body or "").encode(), page, segment)
            at += 1
            first.append(made[0])
            more += made[1:]
        files = [b"".join(first), b"".join(map(_zipped, reversed(more)))]
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.binary())], names=["content"])


def files(pages: DataFrame, segment: int = SEGMENT_BYTES) -> DataFrame:
    """(content): WARC files of pages (page_id, url, html), with chunked bodies in segments. A null html is an empty body;
    null ids and urls have no field; bytes that are no UTF-8 become replacement characters; each repeated row is a record of its own."""
    rows = pages.select(F.col("page_id").cast("string"), readable(F.col("url")).alias("url"), readable(F.col("html")).alias("html"))
    return rows.mapInArrow(lambda x: _written(segment, x), "content binary")
