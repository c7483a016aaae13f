"""WARC archives: a writer for pages and a reader that salvages what is left of damaged files.

The writer lets Spark's text source write the records, on whatever file system the
path names, and a lost task's file is written again.  Each record is a gzip member of
its own, so damage costs the records it meets and no later ones; the text source's
line separator is a member of no bytes.  Without compression a record is a string and
the separator the blank lines that end it, which gives plain WARC 1.1.  Files hold a
bounded number of records.

The reader takes whole files, which that bound keeps small.  Where a gzip member or
a record fails its checks (gzip's own, version line, length, end mark, payload
digest), it searches for the next member or version line that passes them, goes on
there, and reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.text import releasing
from millwright.sources.scratch import materialize

END = b"\r\n\r\n"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
EMPTY_MEMBER = zlib.compress(b"", wbits=31)
RECORDS_PER_FILE = 2_000
#: A file has so many bytes of bodies at most, or a single record; Spark reads files below 2 GB whole.
FILE_BYTES = 1 << 30
#: Digits of a content length that is taken for one, and the digests that are checked.
MOST_DIGITS = 18
DIGESTS = ("sha256", "sha1", "md5", "sha512")
#: Bodies shorter than this are written again rather than referred to.
MIN_REVISIT_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


# ---- writer ---------------------------------------------------------------


def _revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, first_id) of the bodies of ``min_bytes`` or more that several rows have."""
    return pages.where(F.col("__size") >= min_bytes).groupBy("__digest").agg(
        F.min("__id").alias("__first"), F.count("*").alias("__n")
    ).where("__n > 1 and __first is not null").select(F.col("__digest").alias("__same"), "__first")


def _record(kind: Column, body: Column, date: str) -> Column:
    url = F.regexp_replace(F.coalesce("__url", F.lit("")), r"[\x00-\x20\x7f]+", "%20")
    block = F.concat(F.lit(HTTP_HEAD), body)
    refers = F.when(kind == "revisit", F.concat(
        F.lit("WARC-Refers-To: <urn:page:"), F.col("__first").cast("string"),
        F.lit(f">\r\nWARC-Profile: {REVISIT_PROFILE}\r\n"))).otherwise(F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("__id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), url, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha256:"),
        F.col("__digest"), F.lit("\r\n"), refers,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def _members(records: DataFrame) -> DataFrame:
    """(record) as the bytes of a gzip member, in a string column as the text source takes them."""

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [zlib.compress(value.as_py() + END, wbits=31) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["record"])

    packed = records.select(F.col("record").cast("binary")).mapInArrow(releasing(compressed), "record binary")
    return packed.select(F.col("record").cast("string"))


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z",
    records_per_file: int = RECORDS_PER_FILE, compression: str = "member",
) -> None:
    """Write a record per row of ``pages`` below ``path``.

    Of rows with equal bodies of ``min_revisit_bytes`` or more, those with the
    smallest id are responses and the others revisits without a body, which name
    that id and carry the digest of the body.  Shorter bodies are all responses.
    A null body is empty, a null url too; a null id gives a record id without a
    number and never the smallest one.

    ``compression``: 'member' makes each record a gzip member, 'none' leaves records
    as they are, and any other codec of the text source compresses a file as a whole,
    of which damage can cost all that follows.
    """
    rows = pages.select(
        F.col(page_id).alias("__id"), F.col(url).alias("__url"),
        F.coalesce(F.col(html), F.lit("")).alias("__html"),
    ).withColumns({"__digest": F.sha2(F.col("__html").cast("binary"), 256), "__size": F.octet_length("__html")})
    same = _revisits(rows, min_revisit_bytes)
    joined = rows.join(same, F.col("__digest") == F.col("__same"), "left")
    again = F.col("__first").isNotNull() & ~F.col("__id").eqNullSafe(F.col("__first"))
    record = F.when(again, _record(F.lit("revisit"), F.lit(""), date)).otherwise(
        _record(F.lit("response"), F.col("__html"), date))
    records, separator, encoding = joined.select(record.alias("record")), END.decode(), "utf-8"
    if compression == "member":
        records, separator, encoding, compression = _members(records), EMPTY_MEMBER.decode("latin-1"), "iso-8859-1", "none"
    longest = rows.agg(F.max("__size").alias("n")).first().n or 0
    records_per_file = max(1, min(records_per_file, FILE_BYTES // max(longest, 1)))
    records.write.option("lineSep", separator).option("encoding", encoding).option(
        "compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


# ---- reader ---------------------------------------------------------------


@dataclass(frozen=True)
class Record:
    member: int  # where its gzip member starts in the file; -1: not compressed
    start: int  # where it starts in the member or the file
    end: int
    headers: dict[str, str]
    payload: bytes


@dataclass(frozen=True)
class Gap:
    member: int
    start: int
    end: int
    reason: str


class Failed(ValueError):
    """A check that a record did not pass; version lines from its own to ``past`` do not pass either."""

    def __init__(self, reason: str, past: int):
        super().__init__(reason)
        self.past = past


def _parse(data: bytes, at: int, member: int) -> Record:
    version = VERSION.match(data, at)
    if version is None:
        raise Failed("no version line", at + 1)
    headers: dict[str, str] = {}
    lines: dict[str, int] = {}
    line = version.end()
    key = ""
    while (line_end := data.find(b"\r\n", line)) != line:  # to the blank line, however far
        if line_end < 0:
            raise Failed("the header does not end", len(data))
        if key and data[line] in b" \t":  # a folded line goes on with the one before
            headers[key] += " " + data[line:line_end].decode("utf-8", "replace").strip()
            line = line_end + 2
            continue
        name, colon, value = data[line:line_end].partition(b":")
        if not colon:
            raise Failed("a header line without a colon", line)
        key = name.decode("latin-1").strip().lower()
        headers[key], lines[key] = value.decode("utf-8", "replace").strip(), line
        line = line_end + 2
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) <= MOST_DIGITS):
        raise Failed("no content length", line)
    if not headers.get("warc-record-id") or not headers.get("warc-type"):
        raise Failed("no record id or type", line)
    start = line + 2
    end = start + int(length)
    if data[end : end + len(END)] != END:
        raise Failed("truncated" if end > len(data) else "no end mark after the block", line)
    payload = data[start:end]
    in_parts = False  # the digest of a body sent in chunks is that of the body put together
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = payload.partition(END)
        in_parts = b"transfer-encoding" in head.lower()
    if headers.get("warc-type") != "revisit" and not in_parts:
        if not _agrees(payload, headers.get("warc-payload-digest", "")):
            raise Failed("payload digest differs", min(lines[k] for k in ("warc-payload-digest", "content-type") if k in lines))
    return Record(member, at, end + len(END), headers, payload)


def _agrees(payload: bytes, stated: str) -> bool:
    """Whether a stated digest, in hexadecimal or base 32, is the payload's; one of an unknown kind is not checked."""
    kind, _, value = stated.partition(":")
    if kind.lower() not in DIGESTS:
        return True
    own = hashlib.new(kind.lower(), payload)
    return value.lower() == own.hexdigest() or value.rstrip("=").upper() == base64.b32encode(own.digest()).decode().rstrip("=")


def _records(data: bytes, member: int, whole: bool = True) -> Iterator[Record | Gap]:
    """Records of an inflated member (or a plain stretch), and the gaps between them."""
    at = 0
    while at < len(data):
        try:
            record = _parse(data, at, member)
        except Failed as failure:
            found, past = None, failure.past
            for version in VERSION.finditer(data, at + 1):  # after lost bytes not at a line's start
                if version.start() < past:
                    continue
                try:
                    found = _parse(data, version.start(), member)
                    break
                except Failed as later:
                    past = later.past
            end = len(data) if found is None else found.start
            yield Gap(member, at, end, str(failure) if whole or found else "the member breaks off")
            if found is None:
                return
            record = found
        yield record
        at = record.end


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What a member at ``at`` gives, where it ends, and what is wrong with it ('' if nothing)."""
    inflater = zlib.decompressobj(31)
    parts = []
    end = at
    try:
        while end < len(data) and not inflater.eof:  # in steps, to keep what came before damage
            parts.append(inflater.decompress(data[end : end + (1 << 16)]))
            end += 1 << 16
    except zlib.error as error:
        return b"".join(parts), -1, str(error)
    if not inflater.eof:
        return b"".join(parts), -1, "truncated"
    return b"".join(parts), min(end, len(data)) - len(inflater.unused_data), ""


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Every record of an archive that passes its checks, and every stretch that does not.

    Takes plain files and files of gzip members, one record each or many.  Offsets
    of a gap with ``member`` -1 are of the file, else of the inflated member.
    """
    at, broken, reason, past = 0, -1, "", 0
    while at < len(data):
        start = at
        if data.startswith(MEMBER, at):
            inflated, end, wrong = _inflate(data, at)
            if not wrong:
                found = list(_records(inflated, at))
                if found or not inflated:
                    if broken >= 0:
                        yield Gap(-1, broken, start, reason)
                        broken = -1
                    yield from found
                    at = end
                    continue
                wrong = "no record inside"
            rescued = [x for x in _records(inflated, at, whole=False) if isinstance(x, Record)]
            yield from rescued
        else:
            try:
                record = _parse(data, at, -1)
                if broken >= 0:
                    yield Gap(-1, broken, start, reason)
                    broken = -1
                yield record
                at = record.end
                continue
            except Failed as failure:
                wrong, past = str(failure), failure.past
        if broken < 0:
            broken, reason = at, wrong
        at = _next_start(data, at + 1, past)
    if broken >= 0:
        yield Gap(-1, broken, len(data), reason)


_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def _next_start(data: bytes, at: int, past: int) -> int:
    """The next member, or version line from ``past`` on."""
    for found in _START.finditer(data, at):
        if found.start() >= past or data.startswith(MEMBER, found.start()):
            return found.start()
    return len(data)


READ_SCHEMA = (
    "path string, kind string, member_offset long, start_offset long, end_offset long, warc_type string, "
    "record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes long, "
    "payload binary, reason string"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per record (kind 'record') and per gap (kind 'gap') of the files below ``path``.

    ``payload_digest`` and ``payload_bytes`` are measured on the payload that was
    read; a revisit, which has none, carries its stated digest and null bytes.
    Without ``with_payload`` the payload is null.  An empty file has no rows.
    """
    schema = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]])
                        for f in READ_SCHEMA.split(", ")])

    def row(file: str, item: Record | Gap) -> dict:
        if isinstance(item, Gap):
            return {"path": file, "kind": "gap", "member_offset": item.member, "start_offset": item.start,
                    "end_offset": item.end, "reason": item.reason}
        head, revisit = item.headers, item.headers.get("warc-type") == "revisit"
        return {
            "path": file, "kind": "record", "member_offset": item.member, "start_offset": item.start,
            "end_offset": item.end, "warc_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
            "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"),
            "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha256:") if revisit
            else hashlib.sha256(item.payload).hexdigest(),
            "payload_bytes": None if revisit else len(item.payload),
            "payload": item.payload if with_payload and not revisit else None,
        }

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for item in salvage(content.as_py()):
                    rows.append(row(file.as_py(), item))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, READ_SCHEMA)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def resolved(rows: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records of archived pages.

    A revisit gets its length from the response that it refers to; if that one is
    lost, the length is null.
    """
    records = rows.where("kind = 'record'").select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))
    bodies = records.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest")
    ).agg(F.first("payload_bytes").alias("__bytes"))
    revisits = records.where("record_type = 'revisit'")
    back = (F.col("refers_to") == F.col("__id")) & (F.col("payload_digest") == F.col("__digest"))
    found = revisits.join(bodies, back, "left").select(
        "page_id", F.col("__bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return records.where("record_type = 'response'").unionByName(found)


def archived(pages: DataFrame, path: str, **columns) -> DataFrame:
    """Write ``pages`` to ``path`` and give what can be read back of them, as :func:`resolved` does.

    The rows given are read already; the archives stay for others.  Stretches that could
    not be read back raise with their count, for a page in one would be missing.  Bodies
    and urls may be of any length below Spark's bound of 2 GB a file; other columns are
    not read.
    """
    write_archives(pages, path, **columns)
    rows = materialize(read_archives(pages.sparkSession, path, with_payload=False), "warc-records")
    gaps = rows.where("kind = 'gap'").count()
    if gaps:
        raise ValueError(f"{gaps} stretches of the archives below {path} could not be read")
    return resolved(rows)
