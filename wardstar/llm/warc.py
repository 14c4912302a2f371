"""WARC archives: a writer with revisits, and a reader that splits gzipped archives.

Every record is a gzip member of its own. A reading task gets a byte range, looks
for gzip's magic from its start on, takes a place for a member only if the header
of a WARC record decodes there, and owns the records that start inside its range.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import cut, dealt, emit, table, work_folder
from wardstar.llm.files import opened, write_file

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_ID = "<urn:page:{}>"
#: Bytes read at once, and bytes within which a record's first line must decode.
READ = 1 << 20


class Record(NamedTuple):
    """A record; header names in lower case."""

    headers: dict[str, str]
    payload: bytes


class Damage(NamedTuple):
    """Bytes between records, or at an end of an archive, that hold no whole record."""

    path: str
    start: int
    stop: int


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member. A revisit has no payload, only its digest and length."""
    block = HTTP if refers_to is not None else HTTP + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": RECORD_ID.format("" if page_id is None else page_id),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        headers["WARC-Target-URI"] = " ".join(url.split())
    if refers_to is not None:
        headers["WARC-Refers-To"] = RECORD_ID.format(refers_to)
        headers["WARC-Profile"] = REVISIT_PROFILE
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    data = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes) -> Record:
    """Header lines may have names in any case and any white space after the colon."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    headers = {name.strip().lower(): value.strip() for name, _, value in lines}
    block = rest[: int(headers["content-length"])]
    if len(block) < int(headers["content-length"]):
        raise ValueError("the record is shorter than it says")
    is_http = headers.get("content-type", "").lower().startswith("application/http")
    return Record(headers, block.partition(b"\r\n\r\n")[2] if is_http else block)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, min_bytes: int = 0, file_bytes: int = 1 << 24) -> DataFrame:
    """One record for each row of ``pages`` (page_id, url, html); the archives' manifest.

    A null html is an empty payload. Of rows with equal payloads of at least
    ``min_bytes`` the one with the largest page_id becomes the response and the
    others revisit it; rows that repeat this page_id are responses too, and a
    group without any page_id has responses only. The manifest, written by Spark,
    has path and bytes of each archive; an empty table gives none.
    """
    spark = pages.sparkSession
    folder = work_folder(spark, "archives")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.unhex(F.sha1(payload)).alias("digest")
    )
    # Counted by digest before anything moves, so a payload of many pages is one row.
    largest = rows.groupBy("digest").agg(F.max("page_id").alias("largest"))
    rows = rows.join(largest, "digest").withColumn(
        "refers_to",
        F.when(
            (F.octet_length("payload") >= min_bytes)
            & ~F.coalesce("page_id", F.col("largest") - 1).eqNullSafe(F.col("largest")),
            F.col("largest"),
        ),
    )
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            path = write_file(folder, "pages.warc.gz", b"".join(members))
            return emit(schema, path=[path], bytes=[size])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, data, digest, refers_to = (c[i].as_py() for c in columns)
                text = base64.b32encode(digest).decode()
                members.append(record_bytes(page_id, url, data, text, refers_to))
                size += len(members[-1])
                if size >= file_bytes:
                    yield flush()
                    members, size = [], 0
        if members:
            yield flush()

    kept = rows.select("page_id", "url", "payload", "digest", "refers_to")
    return cut(kept.mapInArrow(write, "path string, bytes long"), "archive-manifest")


class Member:
    """Decodes one gzip member of a file, from a place on, as its bytes come in."""

    def __init__(self, file, place: int, size: int):
        self.file, self.place, self.size = file, place, size
        self.unpack = zlib.decompressobj(31)
        self.data = bytearray()

    def grow(self) -> bool:
        """Decode a bit more; false once the member or the file has ended."""
        if self.unpack.eof or self.place >= self.size:
            return False
        self.file.seek(self.place)
        raw = self.file.read(READ if self.data else 1 << 14)
        self.place += len(raw)
        self.data += self.unpack.decompress(raw)
        return True

    def is_record(self) -> bool:
        """Whether the header of a record decodes here."""
        try:
            while len(self.data) < len(VERSION) and self.grow():
                pass
        except zlib.error:
            return False
        return bytes(self.data[: len(VERSION)]) == VERSION

    def finish(self) -> int:
        """Decode to the end; the place where the next member may start."""
        while self.grow():
            pass
        if not self.unpack.eof:
            raise zlib.error("the archive ends inside a record")
        return self.place - len(self.unpack.unused_data)


def _record_at(file, place: int, size: int) -> tuple[Record, int] | None:
    """The record that starts at a place, and where it ends; nothing where none does."""
    member = Member(file, place, size)
    if place >= size or not member.is_record():
        return None
    try:
        after = member.finish()
        return parse_record(bytes(member.data)), after
    except (zlib.error, ValueError, KeyError):
        return None


def records(path: str, start: int, stop: int) -> Iterator[Record | Damage]:
    """The records of an archive that start at ``start`` or later, before ``stop``.

    From ``start`` on, what looks like a member and is none (the magic inside packed
    data) is passed over to the next magic. Once one record is found, or from the
    start of the archive, another must follow right behind until the archive ends;
    bytes that hold none are a ``Damage``, told by the task that owns the record
    before them.
    """
    system, name = opened(path)
    with system.open_input_file(name) as file:
        size = file.size()
        place, stop = start, min(stop, size)
        expected = place == 0
        while place < stop:
            if found := _record_at(file, place, size):
                yield found[0]
                place, expected = found[1], True
                continue
            gap = place
            place = _next_record(file, place + 1, size if expected else stop, size)
            if expected:
                yield Damage(path, gap, place)
        if expected and stop <= place < size and not _record_at(file, place, size):
            yield Damage(path, place, _next_record(file, place + 1, size, size))


def _next_record(file, place: int, stop: int, size: int) -> int:
    """The first place from ``place`` on, before ``stop``, where a whole record starts."""
    while place < stop:
        place = _next_magic(file, place, min(stop + len(MAGIC) - 1, size))
        if place >= stop or _record_at(file, place, size):
            break
        place += 1
    return min(place, stop)


def _next_magic(file, place: int, stop: int) -> int:
    """The first place of the magic from ``place`` on, or ``stop``."""
    while place + len(MAGIC) <= stop:
        file.seek(place)
        raw = file.read(min(READ, stop - place))
        found = raw.find(MAGIC)
        if found >= 0:
            return place + found
        place += len(raw) - len(MAGIC) + 1
    return stop


def read_archives(
    manifest: DataFrame, range_bytes: int = 1 << 22, report_damage: bool = False
) -> DataFrame:
    """Every record of the archives in the manifest (path, bytes), read by byte ranges.

    Returns page_id, url, record_type, refers_to (a page_id), payload_bytes,
    payload_digest and payload (null for a revisit). A record identified otherwise has
    no page_id. Length and digest of a response are those of the bytes read, and must
    be the ones in its header, if it has any. Bytes that hold no whole record raise an
    error; with ``report_damage`` they are a row of record_type ``damaged`` with the
    archive and the first byte as url and their number as payload_bytes.
    """
    size = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    ranges = manifest.where("bytes > 0").select(
        "path",
        F.explode(F.expr(f"sequence(0L, bytes - 1, {range_bytes}L)")).alias("start"),
    )
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, held = [], 0
                for r in records(row["path"], row["start"], row["start"] + range_bytes):
                    if isinstance(r, Damage):
                        if not report_damage:
                            raise ValueError(f"{r.path} holds no record at bytes {r.start} to {r.stop}")
                        place = f"{r.path}@{r.start}"
                        found.append((None, place, "damaged", None, r.stop - r.start, None, None))
                        continue
                    found.append(_row(r))
                    held += len(r.payload)
                    if held > READ:
                        yield _rows(schema, found)
                        found, held = [], 0
                if found:
                    yield _rows(schema, found)

    return dealt(ranges, size).mapInArrow(
        read,
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary",
    )


def _page(urn: str | None) -> int | None:
    """The page_id in a record's identifier, where it is one that this module writes."""
    prefix, suffix = RECORD_ID.split("{}")
    number = (urn or "").removeprefix(prefix).removesuffix(suffix)
    return int(number) if number.removeprefix("-").isdigit() else None


def _row(record: Record) -> tuple:
    h = record.headers
    kind, length = h["warc-type"], h.get("warc-payload-length")
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload = None if kind == "revisit" else record.payload
    if payload is not None:
        read = payload_digest(payload)
        is_base32 = digest and len(digest) == len(read)
        if (length and len(payload) != int(length)) or (is_base32 and read != digest.upper()):
            raise ValueError(f"{h.get('warc-record-id')}: the payload is damaged")
        length, digest = len(payload), read
    return (
        _page(h.get("warc-record-id")), h.get("warc-target-uri"), kind,
        _page(h.get("warc-refers-to")), int(length) if length is not None else None, digest, payload,
    )


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return emit(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))


def query(spark, sf_dir: str) -> DataFrame:
    found = read_archives(write_archives(table(spark, sf_dir, "pages"), min_bytes=0))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
