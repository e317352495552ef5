"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

Writing.  Every page becomes one record, compressed as a gzip member of its
own.  Of pages with equal payloads of at least ``min_revisit`` bytes, the one
with the least id becomes a response and the others revisits that refer to it.
Files are written by Spark's text sink, so that its commit protocol holds where
executors are lost, on any file system that Spark writes to: the record's bytes
are the line, or a run of several records', and the line separator is an empty
gzip member.

Reading.  Files are cut into members and records.  Where a check fails (gzip
data, version line, headers, block length or payload digest), the reader looks
for the next place at which a member or a version line begins and whose record
passes all checks, goes on there, and reports the bytes in between as a gap
with the failed check.  The same is done inside a member that holds several
records; of a damaged or cut member, what can still be decompressed is
searched, and records are taken whose payload digest agrees.  Gaps inside a
member have their place in its content (``inner_offset``) beside the member's
in the file.  Plain and compressed archives are told apart by place, so mixed
files are read too.

Defined results: a null payload is empty; a null URL leaves the target out, and
characters that a header can't hold are percent-encoded; a null ``page_id`` is
stored and read as null and may be referred to only where all copies have none.
Rows that repeat the least id of their payload are responses, too.  Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .skew import lookup

MIN_REVISIT, LEVEL = 100, 1
#: Records a file and, about, its bytes (a longer record stands alone); they bound what a reader holds in memory at once.
FILE_ROWS, FILE_BYTES = 2_000, 64 << 20
#: Lines of the text sink a file; a line holds several records.
_LINES = 16
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" "0300" "00000000" "00000000")
MAGIC, VERSION, END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FEED = 1 << 14
#: Headers of a record end within so many bytes.
MOST_HEADERS = 1 << 15
_DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one uncompressed record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def _records(level: int, most_rows: int, most_bytes: int):
    """Lines for the text sink: runs of compressed records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def line() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

        for batch in batches:
            for row in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "refers_to", "revisit")), strict=True):
                page_id, url, html, digest, refers_to, revisit = (x.as_py() for x in row)
                made = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = made.compress(record(page_id, url, (html or "").encode(), digest, refers_to, revisit)) + made.flush()
                if held and (len(held) >= most_rows or size + len(member) > most_bytes):
                    yield line()
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield line()

    return run


def write(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, level: int = LEVEL, file_rows: int = FILE_ROWS) -> None:
    """Archive ``pages (page_id, url, html)`` in the folder ``path``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    keyed = rows.select("page_id", F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).alias("bytes"))
    groups = keyed.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("c")).where("c > 1")
    rows = rows.withColumn("digest", F.sha2(html.cast("binary"), 256))
    with Scratch(pages.sparkSession) as scratch:
        groups = scratch.table(groups.withColumn("copies", F.lit(True)), "groups")
        _write(lookup(rows, ["digest"], groups, "c", max(1, pages.count()), groups.count()), path, level, file_rows)


def _write(rows: DataFrame, path: str, level: int, file_rows: int) -> None:
    revisit = F.coalesce(F.col("copies") & ~F.col("page_id").eqNullSafe(F.col("refers_to")), F.lit(False))
    rows = rows.withColumn("revisit", revisit).drop("copies")
    per_file = min(_LINES, file_rows)
    lines = rows.mapInArrow(_records(level, file_rows // per_file, FILE_BYTES // _LINES), "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", per_file).text(path)


class Bad(Exception):
    """A check that a record has failed."""


@dataclass
class Record:
    """A record as it was read; ``payload`` is None for a revisit.

    ``inner`` and ``inner_length`` tell where it lies in its member's content.
    """

    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    payload: bytes | None = None
    payload_bytes: int = 0
    compared: bool = False
    member: bool = False
    inner: int | None = None
    inner_length: int | None = None


def _parsed(data: bytes, at: int) -> tuple[Record, int]:
    """The record whose version line begins at ``at``, and where it ends."""
    if not re.fullmatch(rb"WARC/1\.\d\r\n", data[at : at + 10]):
        raise Bad("version")
    end = data.find(END, at, at + MOST_HEADERS)
    if end < 0:
        raise Bad("headers")
    lines = data[at:end].decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("headers")
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        raise Bad("headers")
    start, stop = end + 4, end + 4 + int(headers["content-length"])
    if data[stop : stop + 4] != END:
        raise Bad("length")
    got = Record(at, stop + 4 - at, headers, data[start:stop])
    http, blank, body = got.block.partition(END)
    if headers.get("content-type", "").startswith("application/http"):
        if not blank:
            raise Bad("http")
        size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        got.payload_bytes = int(size[1]) if size else len(body)
        if headers["warc-type"] != "revisit":
            got.payload = body
            if len(body) != got.payload_bytes:
                raise Bad("length")
    else:
        got.payload, got.payload_bytes = got.block, len(got.block)
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if got.payload is not None and kind in ("sha256", "sha1"):
        found = hashlib.new(kind, got.payload)
        if digest.lower() != found.hexdigest() and digest.upper() != base64.b32encode(found.digest()).decode():
            raise Bad("digest")
        got.compared = True
    return got, stop + 4


def _inflated(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """The content of the gzip member at ``at`` as far as it can be read, where it ends, and whether it's whole."""
    made, parts, view, end = zlib.decompressobj(31), [], memoryview(data), at
    try:
        while not made.eof and end < len(data):
            parts.append(made.decompress(view[end : end + _FEED]))
            end = min(end + _FEED, len(data))
        return b"".join(parts), end - len(made.unused_data), made.eof
    except zlib.error:
        pass
    # What an error takes with it is read again byte by byte, up to the damaged one.
    made = zlib.decompressobj(31)
    parts = [made.decompress(view[at:end])]
    try:
        while end < len(data):
            parts.append(made.decompress(view[end : end + 1]))
            end += 1
    except zlib.error:
        pass
    return b"".join(parts), end, False


def _inside(content: bytes, checked: bool) -> Iterator[Record | tuple[int, int, str]]:
    """Records of a member's content, and gaps between them; with ``checked`` only records whose digest was compared."""
    at, start, reason = 0, 0, ""
    while at < len(content):
        try:
            got, end = _parsed(content, at)
            if checked and not got.compared:
                raise Bad("unverified")
        except Bad as bad:
            start, reason = (start, reason) if reason else (at, str(bad))
            at = content.find(VERSION, at + 1)
            at = at if at >= 0 else len(content)
            continue
        if reason:
            yield start, at, reason
            reason = ""
        yield got
        at = end
    if reason:
        yield start, len(content), reason


@dataclass
class _Step:
    """What stands at a place: records and gaps of a member's content or a plain record, where it ends (None: unknown), and how much content there was."""

    rows: list
    end: int | None
    content: int = 0


def _step(data: bytes, at: int) -> _Step:
    """What can be read at ``at``; a member gives its sound records even where others are damaged or its end is."""
    if data[at : at + 3] != MAGIC:
        got, end = _parsed(data, at)
        return _Step([got], end)
    content, end, whole = _inflated(data, at)
    rows = list(_inside(content, not whole))
    records = [r for r in rows if isinstance(r, Record)]
    if not whole and not records:
        raise Bad("gzip")
    if content and not records:
        raise Bad(rows[0][2])
    for got in records:
        got.inner, got.offset, got.member = got.offset, at, True
    return _Step(rows, end if whole else None, len(content))


def salvage(data: bytes) -> Iterator[Record | tuple]:
    """Records of an archive, and gaps: ``(start, end, reason)``, and behind it the bounds inside the content where a gap lies in a member."""
    at, ahead, ready = 0, {MAGIC: -1, VERSION: -1}, None

    def search(at: int) -> tuple[int, _Step | None]:
        """The next place with something sound, and what stands there."""
        while at < len(data):
            for mark, place in ahead.items():
                if place < at:
                    place = data.find(mark, at)
                    ahead[mark] = place if place >= 0 else len(data)
            at = min(ahead.values())
            try:
                if at < len(data):
                    return at, _step(data, at)
            except Bad:
                at += 1
        return len(data), None

    while at < len(data):
        start = at
        try:
            found, ready = ready or _step(data, at), None
        except Bad as bad:
            at, ready = search(at + 1)
            yield start, at, str(bad)
            continue
        at, ready = (found.end, None) if found.end is not None else search(at + 1)
        for row in found.rows:
            if isinstance(row, tuple):
                yield start, at, row[2], row[0], row[1]
                continue
            if row.member:
                row.inner_length, row.length = row.length, at - start
            yield row
        if found.end is None:
            yield start, at, "gzip", found.content, found.content


def _page(urn: str | None) -> int | None:
    got = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(got[1]) if got else None


_SCHEMA = "file string, kind string, offset bigint, length bigint, reason string, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, inner_offset bigint, inner_length bigint"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def _read(with_payload: bool):
    def rows(name: str, data: bytes):
        for got in salvage(data):
            if isinstance(got, tuple):
                inside = (got[3], got[4] - got[3]) if len(got) > 3 else (None, None)
                yield name, "gap", got[0], got[1] - got[0], got[2], *[None] * 7, *inside
                continue
            h = got.headers
            digest = h.get("warc-payload-digest", "").partition(":")[2] or (hashlib.sha256(got.payload).hexdigest() if got.payload is not None else None)
            yield name, "record", got.offset, got.length, None, _page(h.get("warc-record-id")), h.get("warc-target-uri"), h["warc-type"], _page(h.get("warc-refers-to")), got.payload_bytes, digest, got.payload if with_payload else None, got.inner, got.inner_length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for n, x in zip(_NAMES, _SCHEMA.split(", "), strict=True)])
        for batch in batches:
            for name, data in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                held = []
                for row in rows(name, data.as_py()):
                    held.append(row)
                    if len(held) == 512:
                        yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in held], schema)
                        held = []
                yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in held], schema)

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records (``kind`` record) and quarantined gaps (``kind`` gap) of all files under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read(with_payload), _SCHEMA)
