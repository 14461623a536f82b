"""WARC archives: a writer with revisit records and a salvage reader.

Writing: equal payloads of at least ``least_revisit`` bytes are stored once, in
the response of the largest id; the others become revisits of it. Each record
is a gzip member (or plain), packed into files of about ``file_bytes`` by
Spark's text writer, whose line ends are zero bytes, the padding that gzip
allows between members. So the files go wherever Spark can write, with its
commit protocol.

Reading: every member's checksum, every record's version line, headers, length
and digests are checked. Where a check fails, the reader looks for the next
gzip member or version line at which a whole valid record starts, goes on from
there, and logs the bytes between as a quarantined gap with the first reason. Of a
member that fails, what does inflate is searched for version lines in the same way:
its valid records are kept (from the member's start to the next sound one) and its
inner gaps are logged with their places in the inflated bytes.

Null payloads count as empty; null ids and addresses are left out of the
record. A null id never refers to or is referred to as the largest; rows that
repeat the largest id with the same payload are all responses. Empty tables
give an archive without files and no rows. Other columns are ignored, whatever their names.
A record is one value in a task, so a payload may be as long as Spark's values, and
the reader takes a file as one value: files up to 2 GB, each inflated member by member.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
VERSION_LINE = re.compile(rb"WARC/1\.\d\r\n")
# Fixed values of the WARC 1.1 and HTTP formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, BLANK = b"\r\n", b"\r\n\r\n"
RECORD = ("file string, start long, end long, reason string, record_type string, id long, url string, "
          "payload_bytes long, payload_digest string, refers_to long, payload binary")


@dataclass(frozen=True)
class WarcParams:
    least_revisit: int = 1000
    file_bytes: int = 32 << 20
    compress: bool = True
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def base32(digest_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(digest_hex)).decode()


def record_bytes(record_type: str, page: int | None, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: int | None, params: WarcParams) -> bytes:
    """One record; ``payload`` is empty for a revisit, ``size`` and ``digest`` (hex) are of the full one."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    name = f"<urn:page:{page}>" if page is not None else f"<urn:sha1:{digest}>"
    head = [f"WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {name}", f"WARC-Date: {params.date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{base32(digest)}")
    head.append(f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).hexdigest())}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + BLANK + block + BLANK


def member(record: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def with_roles(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """``pages`` (id long, url, payload binary) with size, digest, refers_to (null: a response).

    The payloads are joined by id and digest, never by digest alone, so a payload
    that very many pages share is spread over all tasks.
    """
    told = pages.select("id", "url", F.coalesce("payload", F.lit(b"")).alias("payload")).withColumns(
        {"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    narrow = told.select("id", "size", "digest").where(F.col("size") >= params.least_revisit)
    groups = (narrow.groupBy("digest", "size").agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & F.col("keeper").isNotNull()).drop("n"))
    revisits = (narrow.join(groups, ["digest", "size"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
                .select(F.col("id").alias("its_id"), F.col("digest").alias("its_digest"), F.col("keeper").alias("refers_to"))
                .distinct())
    return (told.join(revisits, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest")), "left")
            .drop("its_id", "its_digest"))


def write(pages: DataFrame, path: str, params: WarcParams = WarcParams()) -> None:
    """Write ``pages`` (id, url, payload) as WARC files under ``path``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                r = {c: batch.column(c)[at].as_py() for c in ("id", "url", "payload", "size", "digest", "refers_to")}
                revisit = r["refers_to"] is not None
                made = record_bytes("revisit" if revisit else "response", r["id"], r["url"], b"" if revisit else r["payload"],
                                    r["size"], r["digest"], r["refers_to"], params)
                held.append(member(made, params.level) if params.compress else made)
                size += len(held[-1])
                if size >= params.file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    blobs = with_roles(pages, params).mapInArrow(pack, "value binary")
    # The cast keeps the bytes as they are; one blob to a file.
    (blobs.select(F.col("value").cast("string").alias("value")).write
     .option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))


class Unsound(Exception):
    """A check that failed; its text is the reason."""


def parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` of plain bytes and where it ends; raises Unsound."""
    if not VERSION_LINE.match(data, at):
        raise Unsound("no version line")
    stop = data.find(BLANK, at)
    if stop < 0:
        raise Unsound("headers without end")
    head: dict[str, str] = {}
    for line in data[at:stop].split(END)[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise Unsound("bad header line")
        head[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdecimal():
        raise Unsound("no content length")
    start = stop + 4
    end = start + int(head["content-length"])
    if data[end:end + 4] != BLANK:
        raise Unsound("no end after the block")
    block = data[start:end]
    if not _matches(head.get("warc-block-digest"), block):
        raise Unsound("block digest differs")
    http, gap, payload = block.partition(BLANK)
    if not gap and head.get("content-type", "").startswith("application/http"):
        raise Unsound("no end of HTTP headers")
    if not head.get("content-type", "").startswith("application/http"):
        http, payload = b"", block
    kind = head.get("warc-type", "")
    if kind != "revisit" and not _matches(head.get("warc-payload-digest"), payload):
        raise Unsound("payload digest differs")
    size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    named, told = re.fullmatch(r"<urn:page:(-?\d+)>", head.get("warc-record-id", "")), head.get("warc-payload-digest", "")
    refers = re.fullmatch(r"<urn:page:(-?\d+)>", head.get("warc-refers-to", ""))
    return {"record_type": kind, "id": int(named[1]) if named else None, "url": head.get("warc-target-uri"),
            "payload_bytes": int(size[1]) if kind == "revisit" and size else len(payload),
            "payload_digest": base64.b32decode(told[5:]).hex() if kind == "revisit" and _is_sha1(told) else hashlib.sha1(payload).hexdigest(),
            "refers_to": int(refers[1]) if refers else None, "payload": payload}, end + 4


def _is_sha1(told: str) -> bool:
    return re.fullmatch(r"sha1:[A-Z2-7]{32}", told) is not None


def _matches(told: str | None, data: bytes) -> bool:
    """Digests of other kinds can't be checked and count as matching."""
    return not told or not told.startswith("sha1:") or told == "sha1:" + base32(hashlib.sha1(data).hexdigest())


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends; raises Unsound."""
    z = zlib.decompressobj(31)
    out, pos = [], at
    view = memoryview(data)
    try:
        while not z.eof and pos < len(data):
            out.append(z.decompress(view[pos:pos + (1 << 16)]))
            pos = min(len(data), pos + (1 << 16))
    except zlib.error as e:
        raise Unsound("gzip member: " + re.sub(r"Error -?\d+ while decompressing data: ", "", str(e))) from None
    if not z.eof:
        raise Unsound("gzip member ends early")
    return b"".join(out), pos - len(z.unused_data)


def _sound(data: bytes, at: int) -> tuple[list[dict], int]:
    """The records of the member or plain record at ``at``, all valid; raises Unsound."""
    if not data.startswith(GZIP, at):
        record, end = parse(data, at)
        return [record | {"start": at, "end": end}], end
    plain, end = inflate(data, at)
    out, pos = [], 0
    while pos < len(plain):
        record, pos = parse(plain, pos)
        out.append(record | {"start": at, "end": end})
    return out, end


def _inflated(data: bytes, at: int) -> bytes:
    """All that inflates of the gzip member at ``at``, however it ends."""
    z, out, step = zlib.decompressobj(31), [], 1 << 16
    while at < len(data) and not z.eof:
        before = z.copy()
        try:
            out.append(z.decompress(data[at:at + step]))
        except zlib.error:
            if step == 1:
                break
            z, step = before, 1     # up to the very byte that fails
            continue
        at += step
    return b"".join(out)


def _recovered(data: bytes, at: int, reason: str) -> list[dict]:
    """The valid records and the inner gaps of a member that failed; none without a record."""
    if not data.startswith(GZIP, at):
        return []
    plain, out, pos, found = _inflated(data, at), [], 0, False
    while pos < len(plain):
        try:
            record, pos = parse(plain, pos)
            out.append(record)
            found = True
            continue
        except Unsound as e:
            bad, inner = pos, str(e)
        while (pos := plain.find(VERSION, pos + 1)) >= 0:
            try:
                parse(plain, pos)
                break
            except Unsound:
                pass
        pos = pos if pos >= 0 else len(plain)
        out.append({"reason": f"{reason}; inflated bytes {bad} to {pos}: {inner}"})
    return out if found else []


def _next(data: bytes, at: int) -> int:
    """Where the next member or version line may start, from ``at`` on; the length if nowhere."""
    found = [p for p in (data.find(GZIP, at), data.find(VERSION, at)) if p >= 0]
    return min(found, default=len(data))


def salvage(data: bytes) -> Iterator[dict]:
    """All records that can be recovered from a file, and its gaps (those have a reason), in order."""
    at, n = 0, len(data)
    while at < n:
        if data[at] == 0:  # padding between members
            at += 1
            continue
        try:
            records, at = _sound(data, at)
            yield from records
            continue
        except Unsound as e:
            reason = str(e)
        bad, spot, rows = at, at + 1, _recovered(data, at, reason)
        while (spot := _next(data, spot)) < n:
            try:
                _sound(data, spot)
                break
            except Unsound as e:
                if _recovered(data, spot, str(e)):
                    break
                spot += 1
        if not any("reason" in r for r in rows):
            rows.append({"reason": reason})
        yield from (r | {"start": bad, "end": spot} for r in rows)
        at = spot


def read(spark: SparkSession, path: str, payload: bool = True, glob: str | None = None) -> DataFrame:
    """Records and quarantined gaps of all archive files under ``path``, or of those whose
    names fit ``glob``. Names that start with a dot or an underscore aren't read, as in all of Spark's readers.

    Rows with a ``reason`` are gaps (bytes start to end of ``file``); the others
    are records. ``payload`` leaves the payload column null if false. An archive
    folder without files gives no rows.
    """
    schema = pa.schema([(c, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k])
                        for c, k in (x.split() for x in RECORD.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                name, data = batch.column("path")[at].as_py(), batch.column("content")[at].as_py()
                held, size = [], 0
                for row in salvage(data):
                    row["file"] = name
                    if not payload:
                        row.pop("payload", None)
                    held.append(row)
                    size += 200 + len(row.get("payload") or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "content")
    return files.mapInArrow(run, RECORD)
