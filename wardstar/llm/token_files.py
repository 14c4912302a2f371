"""Token-id files: independent zstandard frames, a trailing seek table, checksums.

A file holds, in the public seekable format, data frames of whole documents' ids
(little-endian unsigned 32-bit), then one frame that lists its documents, then a
skippable frame with the compressed size, size and checksum (low 32 bits of XXH64)
of every frame. A reader of some documents reads the table, the list and the
frames that hold them, and nothing else.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import cut, dealt, emit, table, work_folder
from wardstar.llm.files import opened, write_file
from wardstar.llm.tokens import default_path, encoded

#: Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
#: One entry of a file's list of documents.
LISTED = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("first", "<u8"), ("n", "<u8")])


class FileWriter:
    """Collects documents into frames, and frames into one file's bytes."""

    def __init__(self, frame_bytes: int = 1 << 18):
        self.frame_bytes = frame_bytes
        self.compress = zstandard.ZstdCompressor(level=1).compress
        self.parts: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []
        self.listed: list[tuple] = []
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.open_bytes and self.open_bytes + len(ids) > self.frame_bytes:
            self._frame(b"".join(self.open))
        self.listed.append(
            (doc_id or 0, doc_id is None, len(self.entries), self.open_bytes // 4, len(ids) // 4)
        )
        self.open.append(ids)
        self.open_bytes += len(ids)
        self.size += len(ids)

    def _frame(self, data: bytes) -> None:
        packed = self.compress(data)
        self.parts.append(packed)
        checksum = xxhash.xxh64_intdigest(data) & 0xFFFFFFFF
        self.entries.append((len(packed), len(data), checksum))
        self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self._frame(b"".join(self.open))
        self._frame(np.array(self.listed, LISTED).tobytes())
        rows = b"".join(ENTRY.pack(*e) for e in self.entries)
        footer = FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        head = struct.pack("<II", SKIPPABLE, len(rows) + len(footer))
        return b"".join([*self.parts, head, rows, footer])


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, path: str):
        system, place = opened(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        frames, flags, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        self.file.seek(size - FOOTER.size - frames * ENTRY.size)
        self.entries = list(ENTRY.iter_unpack(self.file.read(frames * ENTRY.size)))
        self.starts = np.cumsum([0, *(e[0] for e in self.entries)])
        self.listed = np.frombuffer(self.frame(frames - 1), LISTED)

    def frame(self, number: int) -> bytes:
        packed, size, checksum = self.entries[number]
        self.file.seek(int(self.starts[number]))
        data = zstandard.ZstdDecompressor().decompress(self.file.read(packed), size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} does not match its checksum")
        return data

    def documents(self, doc_ids: Iterable[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) in the order of the file; of the named documents only, if given."""
        wanted = None if doc_ids is None else set(doc_ids)
        number, data = -1, b""
        for row in self.listed:
            doc_id = None if row["null"] else int(row["doc_id"])
            if wanted is not None and doc_id not in wanted:
                continue
            if row["frame"] != number:
                number = int(row["frame"])
                data = self.frame(number)
            first = int(row["first"]) * 4
            yield doc_id, data[first : first + int(row["n"]) * 4]


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int = 0, file_bytes: int = 1 << 25
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files in ascending doc_id; their manifest.

    A null text is empty, every document ends with ``end_id``, null doc_id come
    first, rows with one doc_id follow each other by text. The manifest, written
    by Spark, has path, at (grows with doc_id), documents and tokens of each file;
    an empty table gives no files.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "token-files")
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(writer: FileWriter) -> pa.RecordBatch:
            path = write_file(folder, "ids", writer.finish())
            return emit(
                schema, path=[path], documents=[len(writer.listed)], tokens=[writer.size // 4]
            )

        writer = FileWriter()
        for batch, ids in encoded(batches, tokenizer):
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                writer.add(doc_id, one + end)
                if writer.size >= file_bytes:
                    yield flush(writer)
                    writer = FileWriter()
        if writer.listed:
            yield flush(writer)

    rows = docs.select("doc_id", "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = rows.mapInArrow(write, "path string, documents long, tokens long")
    return cut(files.withColumn("at", F.monotonically_increasing_id()), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids of every document.

    The running sum over files runs in one task; it has a row per file.
    """
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    size = manifest.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"] * 4
    files = dealt(manifest.select("path", start.alias("start")), size)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, rows, held = row["start"], [], 0
                for doc_id, ids in FileReader(row["path"]).documents():
                    rows.append((doc_id, start, ids))
                    start += len(ids) // 4
                    held += len(ids)
                    if held > 1 << 22:
                        yield _rows(schema, rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(schema, rows)

    return files.mapInArrow(read, "doc_id long, start long, ids binary")


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return emit(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))


def query(spark, sf_dir: str) -> DataFrame:
    manifest = write_token_files(table(spark, sf_dir, "documents"), default_path())
    return read_token_files(manifest).select(
        "doc_id",
        "start",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
