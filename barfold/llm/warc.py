"""WARC archives: written with revisit records for repeated payloads, read back by a salvaging reader.

An archive is a sequence of records, each a gzip member of its own or, uncompressed, delimited by its length.
The reader checks whatever a record states about itself. After a failed check it looks for the next
member or version line at which a valid record starts, goes on there, and reports the bytes between as a gap.
Archives are closed after a number of blocks, so a file, which one task reads whole, is bounded by those
or by its longest record. Any Hadoop file system holds them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barfold.llm.texts import quoted
from barfold.sources.scratch import materialise

#: Bytes of records of a block, before it is written; a longer record is a block of its own.
BLOCK_BYTES = 4 << 20
#: Blocks of an archive.
ARCHIVE_BLOCKS = 8
#: A valid gzip member of no bytes. It ends each block, as Spark's text files put something after each row.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff0300") + bytes(8)
END = b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
URN = "urn:page:"

_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def write(
    pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0, compressed: bool = True,
) -> None:
    """One record per row into archives in the folder ``path``, which must not exist.

    Of rows with equal payloads of at least ``least_bytes`` bytes that with the largest key is a response, as are rows
    repeating that key; the others are revisits that refer to it and carry no payload. If all keys are null, all are
    responses. A null payload is empty, a null or empty url is not written. Other columns are ignored, an empty
    table gives no record. Keys are read back as text.

    Equality is by SHA-256. Only payloads that occur more than once are joined back; a hot payload is
    combined before the shuffle and its rows are split by the adaptive skew join.
    """
    rows = pages.select(
        F.col(quoted(key)).alias("key"), F.col(quoted(url)).alias("url"),
        F.coalesce(F.col(quoted(payload)), F.lit("")).alias("payload"))
    same = F.when(F.octet_length("payload") >= least_bytes, F.sha2(F.encode("payload", "UTF-8"), 256))
    groups = materialise(
        rows.select("key", same.alias("same")).where("same is not null")
        .groupBy("same").agg(F.count("*").alias("rows"), F.max("key").alias("holder"))
        .where("rows > 1 and holder is not null").select("same", "holder"))
    marked = rows.withColumn("same", same).join(groups, "same", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("key").eqNullSafe(F.col("holder"))
    fields = marked.select(
        F.col("key").cast("string"), "url", "payload", F.when(revisit, F.col("holder")).cast("string").alias("refers_to"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(n) for n in range(4)), strict=True):
                data = _record_bytes(*(v.as_py() for v in row), date)
                if compressed:
                    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = deflate.compress(data) + deflate.flush()
                held.append(data)
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    def block(held: list[bytes]) -> pa.RecordBatch:
        data = b"".join(held)
        data = data if compressed else data[: -len(END)]
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["block"])

    # A text file takes the bytes of a string as they are.
    (
        fields.mapInArrow(blocks, "block binary").select(F.col("block").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1").option("compression", "none")
        .option("lineSep", (EMPTY_MEMBER if compressed else END).decode("latin-1"))
        .option("maxRecordsPerFile", ARCHIVE_BLOCKS).text(path)
    )


def _digest(data: bytes | memoryview) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record_bytes(key: str | None, url: str | None, payload: str, refers_to: str | None, date: str) -> bytes:
    body = payload.encode()
    block = RESPONSE_HEAD.format(len(body)).encode() + (body if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{_one_line(key or '')}>",
        f"WARC-Date: {date}",
    ]
    if url:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{URN}{_one_line(refers_to)}>"]
    lines += [
        f"WARC-Payload-Digest: sha1:{_digest(body)}",
        f"WARC-Block-Digest: sha1:{_digest(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + END + block + END


SCANNED = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("problem", pa.string()),
    ("record_type", pa.string()), ("key", pa.string()), ("refers_to", pa.string()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
_FIELDS = ("file string, offset long, length long, problem string, record_type string, key string, refers_to string, "
           "url string, payload_bytes long, payload_digest string, payload binary")


def scan(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``path`` (``problem`` null), and one per quarantined gap.

    A gap has ``file``, ``offset``, ``length`` and the first ``problem`` met there; its other columns are null. A record
    that lies in a gzip member has the member's place. ``payload`` is null for revisits, and for all if not
    asked for with ``payloads``; ``payload_bytes`` of a revisit is the length its HTTP header states. Archives may
    mix members and plain records; an empty folder or file gives no rows.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                file, held, size = batch.column(0)[n].as_py(), [], 0
                for offset, end, found in salvage(memoryview(batch.column(1)[n].as_buffer())):
                    if isinstance(found, str):
                        found = {"problem": found}
                    elif not payloads:
                        found["payload"] = None
                    held.append({"file": file, "offset": offset, "length": end - offset, **found})
                    size += len(found.get("payload") or b"") + 512
                    if size >= BLOCK_BYTES:
                        yield pa.RecordBatch.from_pylist(held, SCANNED)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, SCANNED)

    files = spark.read.format("binaryFile").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(read, _FIELDS)


def records(scanned: DataFrame) -> DataFrame:
    return scanned.where("problem is null").drop("problem")


def gaps(scanned: DataFrame) -> DataFrame:
    """The log of quarantined bytes."""
    return scanned.where("problem is not null").select("file", "offset", "length", "problem")


class Damaged(Exception):
    """A failed check; ``resume`` is where the next record should start if the damage leaves no doubt about that."""

    def __init__(self, problem: str, resume: int | None = None) -> None:
        super().__init__(problem)
        self.resume = resume


def salvage(data: memoryview) -> Iterator[tuple[int, int, dict | str]]:
    """Start, end, and the fields of each record or the problem of each gap, in order; together they cover all bytes
    but members without content."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            end, found, problem = _member(data, at) if bytes(data[at : at + 2]) == b"\x1f\x8b" else _plain(data, at)
        except Damaged as damage:
            if gap is None:
                gap, why = at, str(damage)
            after = _START.search(data, at + 1)
            at = damage.resume or (after.start() if after else len(data))
            continue
        if gap is not None:
            yield gap, at, why
            gap = None
        for record in found:
            yield at, end, record
        if problem:
            yield at, end, problem
        at = end
    if gap is not None:
        yield gap, len(data), why


def _plain(data: memoryview, at: int) -> tuple[int, list[dict], None]:
    end, record = _record(data, at)
    return end, [record], None


def _member(data: memoryview, at: int) -> tuple[int, list[dict], str | None]:
    """End of the gzip member at ``at``, its records, and what is wrong with the rest of it if part of it is."""
    inflate, parts, place, step = zlib.decompressobj(31), [], at, 1 << 13
    while not inflate.eof:
        if place >= len(data):
            raise Damaged("member is cut short")
        try:
            parts.append(inflate.decompress(data[place : place + step]))
        except zlib.error as error:
            raise Damaged(f"member does not inflate: {error}") from None
        place, step = min(place + step, len(data)), min(step * 2, 1 << 20)
    end, content = place - len(inflate.unused_data), memoryview(b"".join(parts))
    found = list(salvage(content))
    good = [f for _, _, f in found if isinstance(f, dict)]
    bad = next((f for _, _, f in found if isinstance(f, str)), None)
    if bad and not good:
        raise Damaged(f"in member: {bad}", end)
    return end, good, f"in member: {bad}" if bad else None


def _find(data: memoryview, what: re.Pattern, at: int, end: int) -> int:
    found = what.search(data, at, end)
    return found.start() if found else -1


_BLANK = re.compile(rb"\r\n\r\n")


def _headers(text: bytes) -> dict[str, str]:
    fields = {}
    for line in text.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


def _length(fields: dict[str, str]) -> int:
    text = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", text):
        raise Damaged("no content length")
    return int(text)


def _record(data: memoryview, at: int) -> tuple[int, dict]:
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    head = _find(data, _BLANK, version.end(), len(data))
    if head < 0:
        raise Damaged("headers are cut short")
    fields = _headers(bytes(data[version.end() : head]))
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise Damaged(f"no {name}")
    start = head + len(END)
    stop = start + _length(fields)
    if bytes(data[stop : stop + len(END)]) != END:
        raise Damaged("no end of record at the stated length")
    end, block = stop + len(END), data[start:stop]
    _check(fields.get("warc-block-digest"), block, "block", end)
    kind = fields.get("warc-type", "")
    payload, size = block, None
    if fields.get("content-type", "").startswith("application/http"):
        split = _find(block, _BLANK, 0, len(block))
        if split < 0:
            raise Damaged("http headers are cut short", end)
        try:
            http = _headers(bytes(block[:split]).partition(b"\r\n")[2]) if b"\r\n" in bytes(block[:split]) else {}
            size = _length(http) if kind == "revisit" else None
        except Damaged as damage:
            raise Damaged(f"http: {damage}", end) from None
        payload = block[split + len(END) :]
    if kind != "revisit":
        size = len(payload)
        _check(fields.get("warc-payload-digest"), payload, "payload", end)
    return end, {
        "record_type": kind, "key": _key(fields.get("warc-record-id")), "refers_to": _key(fields.get("warc-refers-to")),
        "url": fields.get("warc-target-uri"), "payload_bytes": size,
        "payload_digest": fields.get("warc-payload-digest", "").partition(":")[2] or None,
        "payload": None if kind == "revisit" else bytes(payload),
    }


def _check(stated: str | None, data: memoryview, name: str, end: int) -> None:
    """SHA-1 digests are checked; one of another kind says nothing here."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() == "sha1" and value.upper() != _digest(data):
        raise Damaged(f"{name} digest differs", end)


def _key(urn: str | None) -> str | None:
    if urn is None:
        return None
    return urn.strip("<>").removeprefix(URN) or None
