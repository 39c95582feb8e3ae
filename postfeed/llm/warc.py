"""WARC archives: writing pages as records, each with copies as revisits, and reading damaged archives.

Writing: every record is a gzip member of its own. Equal payloads are found by digest on narrow rows; only then do
the wide rows meet the list of copies. Tasks cut their records into archives of a bounded size.

Reading: an archive is gone through record by record. One whose checks fail (checksum, lengths, digests, end mark)
is set aside: the next gzip member or version line from which a record passes all checks ends the gap, and reading
goes on there. Records and gaps together cover every byte of an archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.llm.common import SLICE_BYTES, slices, written
from postfeed.operators.keyed import keyed_join
from postfeed.session import scratch_path

# Bytes from which on a task begins a new archive; a single larger record is an archive of its own.
ARCHIVE_BYTES = 16 << 20

# Payloads of fewer bytes are never revisits of each other.
LEAST_BYTES = 0

# Version written and read, what gzip members begin with, ends of lines, of headers and of records.
VERSION, VERSION_LINE = b"WARC/1.1", re.compile(rb"WARC/(?:0\.\d+|1\.\d+)\r\n")
GZIP, LINE, GAP = b"\x1f\x8b\x08", b"\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Bytes given to the decompressor at a time, the same near a fault, and the most that a record's header may have.
FEED, FINE, HEADER_BYTES = 1 << 16, 64, 1 << 20

RECORD_COLUMNS = (
    "archive string, offset long, length long, inner long, kind string, reason string, type string, record_id string, uri string, "
    "date string, refers_to string, payload_digest string, http_length long, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member whose last byte is 0; a record of 16 MB or more may need an empty member behind it for that."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = packer.compress(record) + packer.flush()
    if packed[-1]:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        packed += packer.flush()
    return packed


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record; headers without a value are left out, control characters and blanks at odd places percent-encoded."""
    given = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    lines = [f"{k}: {_one_line(v)}".encode("utf-8", "surrogatepass") for k, v in given if v is not None]
    return LINE.join([VERSION, *lines]) + GAP + block + GAP


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]|^ | $", lambda m: f"%{ord(m[0]):02X}", value)


def page_id_of(record_id):
    """The page of a record id that ``write_pages`` gave; null for a null page or another id."""
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def _page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None, when: str) -> bytes:
    """A response with the page, or a revisit with its HTTP head alone that refers to an equal one."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    again = refers_to is not None
    headers = [
        ("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", _page_urn(page_id)), ("WARC-Date", when), ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", _page_urn(refers_to) if again else None), ("WARC-Profile", PROFILE if again else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record_bytes(headers, head if again else head + html)


def _archived(when: str, archive_bytes: int):
    """Members with the number of the archive, within the task, that each belongs to."""

    def run(batches):
        from pyspark import TaskContext

        task, archive, size = TaskContext.get().partitionId(), -1, archive_bytes
        for part in slices(batches, "html"):
            numbers, members = [], []
            for page_id, url, html, refers_to in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                body = html or b""
                packed = member(page_record(page_id, url, body, base32_sha1(body), refers_to, when))
                if size and size + len(packed) > archive_bytes:
                    archive, size = archive + 1, 0
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{task}-{archive}>"), ("WARC-Date", when), ("Content-Type", "application/warc-fields")]
                    packed = member(record_bytes(info, b"format: WARC File Format 1.1\r\n")) + packed
                size += len(packed)
                numbers.append(archive)
                # The end of a row is written by Spark.
                members.append(packed[:-1])
            data = pa.array(members, pa.binary())
            text = pa.StringArray.from_buffers(len(data), *data.buffers()[1:])
            yield pa.record_batch([pa.array(numbers, pa.int32()), text], names=["archive", "value"])

    return run


def copies(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Page and digest (hex SHA-1) of every row that is to be a revisit, and the page it refers to.

    Of rows with equal payloads the one with the largest id stays a response; if several have that id, all of them.
    A null id is less than any; if all ids are null, none is a revisit.
    """
    rows = written(pages.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("bytes")), "payloads")
    groups = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    # Copies of one payload may be a third of all rows; hot digests are spread by page.
    met = keyed_join(rows.select("page_id", "digest"), groups.where("n > 1 AND refers_to IS NOT NULL").drop("n"), "digest", "left", spread="page_id")
    return met.where("refers_to IS NOT NULL AND NOT (page_id <=> refers_to)").distinct()


def write_pages(pages: DataFrame, path: str, when: datetime | None = None, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A record for every row of ``pages`` (page_id, url, html), below ``path``.

    Null html is empty, a null url leaves its header out. Rows that repeat are written as often.
    """
    at = (when or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("html"))
    known = written(copies(source, least_bytes), "copies").withColumnRenamed("page_id", "of")
    # The list's size is known, so while it is small the pages stay where they are.
    digest = F.sha1("html")
    rows = source.join(known, (digest == known.digest) & F.col("page_id").eqNullSafe(F.col("of")), "left").select("page_id", "url", "html", "refers_to")
    rows.mapInArrow(_archived(at, archive_bytes), "archive int, value string").write.partitionBy("archive").option("lineSep", "\0").text(path)


class Broken(Exception):
    """Why no record is at a place."""


@dataclass
class Found:
    """A record or gap of an archive; ``inner`` is the place within a decoded gzip member."""

    offset: int
    length: int
    inner: int | None = None
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    http_length: int | None = None
    payload: bytes | None = None


def _digest_fails(stated: str | None, data: bytes) -> bool:
    """Whether data is not what a SHA-1 digest in base 32 or hex says; other digests are not checked."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() != "sha1":
        return False
    return value.upper() != base32_sha1(data) and value.lower() != hashlib.sha1(data).hexdigest()


def parse_record(data: bytes, at: int) -> tuple[int, Found]:
    """The record whose version line is at ``at``, and where it ends. Raises Broken unless all checks pass."""
    version = VERSION_LINE.match(data, at)
    if not version:
        raise Broken("no version line")
    blank = data.find(GAP, at, at + HEADER_BYTES)
    if blank < 0:
        raise Broken("header has no end")
    headers: dict[str, str] = {}
    for line in data[version.end() : blank].split(LINE):
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Broken("header line without a name")
        headers.setdefault(name.strip().lower(), value.strip())
    size = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", size):
        raise Broken("no length")
    start, end = blank + len(GAP), blank + len(GAP) + int(size)
    if end > len(data):
        raise Broken("cut off")
    if data[end : end + len(GAP)] != GAP:
        raise Broken("no end mark where the length says")
    block = data[start:end]
    if _digest_fails(headers.get("warc-block-digest"), block):
        raise Broken("block digest")
    found = Found(at, end + len(GAP) - at, headers=headers, payload=block)
    if headers.get("content-type", "").lower().startswith("application/http"):
        head, _, body = block.partition(GAP)
        found.payload = body
        stated = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", head)
        found.http_length = int(stated[1]) if stated else None
    if headers.get("warc-type") != "revisit" and _digest_fails(headers.get("warc-payload-digest"), found.payload):
        raise Broken("payload digest")
    return end + len(GAP), found


def decoded(data: bytes, at: int, feed: int = FEED) -> tuple[int | None, bytes]:
    """Where the gzip member at ``at`` ends and what it holds.

    Without an end, what was decoded before the fault, but for what the last ``feed`` bytes gave.
    """
    unpacker, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof and fed < len(data):
            parts.append(unpacker.decompress(data[fed : fed + feed]))
            fed = min(len(data), fed + feed)
    except zlib.error:
        return None, b"".join(parts)
    return (fed - len(unpacker.unused_data) if unpacker.eof else None), b"".join(parts)


def _in_member(data: bytes, at: int) -> tuple[int, list[Found]]:
    """Records and gaps within the gzip member at ``at``, and where it ends. Raises Broken if nothing in it can be relied on."""
    end, content = decoded(data, at)
    if end is None:
        raise Broken("member is damaged")
    inside = list(salvage(content, packed=False))
    if content and all(f.reason for f in inside):
        raise Broken(f"member without a record: {inside[0].reason}")
    return end, [Found(at, end - at, f.offset, f.reason, f.headers, f.http_length, f.payload) for f in inside]


def salvage(data: bytes, packed: bool = True) -> Iterator[Found]:
    """All records of an archive that pass their checks, and between them the gaps, in order.

    What a damaged member still yields is gone through too: its records whose block digest is stated and right are
    given, and the gap covers the member. A record whose bytes are whole is found wherever it
    stands, unless it is in the payload of another: a payload that holds a whole record shows it only if the outer
    record is broken.
    """
    at, gap, reason = 0, None, ""
    starts = (GZIP, b"WARC/") if packed else (b"WARC/",)
    ahead = dict.fromkeys(starts, -1)
    while at < len(data):
        rescued: list[Found] = []
        try:
            if packed and data.startswith(GZIP, at):
                end, found = _in_member(data, at)
            else:
                end, record = parse_record(data, at)
                found = [record]
        except Broken as error:
            if gap is None:
                gap, reason = at, str(error)
                if packed and data.startswith(GZIP, at):
                    rescued = [Found(at, 0, f.offset, None, f.headers, f.http_length, f.payload) for f in salvage(decoded(data, at, FINE)[1], False)
                               if not f.reason and "warc-block-digest" in f.headers]
            yield from rescued
            # The nearest place from which a record could be read.
            for mark in starts:
                if ahead[mark] <= at:
                    place = data.find(mark, at + 1)
                    ahead[mark] = place if place >= 0 else len(data)
            at = min(ahead.values())
            continue
        if gap is not None:
            yield Found(gap, at - gap, reason=reason)
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield Found(gap, len(data) - gap, reason=reason)


def _salvaged(batches):
    names = [c.split()[0] for c in RECORD_COLUMNS.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in RECORD_COLUMNS.split(", ")]

    def sent(rows):
        return pa.record_batch([pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for archive, content in zip(batch.column("path"), batch.column("content")):
            rows, size = [], 0
            for f in salvage(content.as_py()):
                h = f.headers
                rows.append((archive.as_py(), f.offset, f.length, f.inner, "gap" if f.reason else "record", f.reason, h.get("warc-type"), h.get("warc-record-id"),
                             h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-refers-to"), h.get("warc-payload-digest"), f.http_length, f.payload))
                size += len(f.payload or b"") + 500
                if size > SLICE_BYTES:
                    yield sent(rows)
                    rows, size = [], 0
            if rows:
                yield sent(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps (``kind``) of all archives below ``path``, plain or in gzip members.

    ``offset`` and ``length`` say which bytes of the archive a row is from; a gap has its ``reason``. The payload is
    the body of an HTTP message, else the block; ``http_length`` is the length that the message's head states. An
    archive is read by one task and held in memory, so it has to be well below what an executor has; those of
    ``write_pages`` are. Empty archives give no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_salvaged, RECORD_COLUMNS)


def archived_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html) what its record says once it is written and read back.

    page_id, payload_bytes, payload_digest (base32 SHA-1), record_type and refers_to. Null html is the empty payload,
    and empty payloads are equal like others. Of equal payloads of at least ``least_bytes`` the largest page_id is the
    response, every row of it if it repeats; a null page_id revisits, and is not referred to. Payloads are of
    any length. An empty table gives an empty result. Other columns are not looked at.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_pages(pages, path, least_bytes=least_bytes, archive_bytes=archive_bytes)
    records = read_archives(pages.sparkSession, path).where("kind = 'record' AND type IN ('response', 'revisit')")
    revisit = F.col("type") == "revisit"
    digest = F.substring_index("payload_digest", ":", -1)
    return records.select(
        page_id_of(F.col("record_id")).alias("page_id"), F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        digest.alias("payload_digest"), F.col("type").alias("record_type"), page_id_of(F.col("refers_to")).alias("refers_to"))
