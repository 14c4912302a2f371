"""Sequences of bounded tokens, documents and attention cost by vector best fit.

Pieces of one length are alike, so the driver packs a histogram of at most
``tokens`` lengths: from the longest down, each run of equal pieces goes into the
open sequences whose residual capacities fit it best. Tasks then look up the
sequence of each piece by its position in the order of lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import cut, emit, firsts, in_order, positions, table
from wardstar.llm.tokens import default_path, encoded


class Capacity(NamedTuple):
    """What one sequence may hold; attention cost is the sum of squared lengths."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024


class Run(NamedTuple):
    """Pieces ``start`` up to ``start + n``, ``each`` to a sequence, from ``sequence`` on."""

    start: int
    n: int
    sequence: int
    each: int
    offset: int
    length: int


WEIGHTS = (1.0, 0.001, 0.001)


def vector_best_fit(
    lengths: list[tuple[int, int]],
    capacity: Capacity,
    choose: str = "norm",
    weights: tuple[float, float, float] = WEIGHTS,
) -> list[Run]:
    """Runs for (length, count), longest first.

    Open sequences with equal residuals are one entry. ``norm`` takes the entry
    with the least weighted norm of the residual left after the piece, ``dot``
    the one with the largest weighted dot product of residual and piece, both
    relative to the capacities. Only entries that hold the piece under every
    constraint count.
    """
    full = np.array(capacity, np.int64)
    weight = np.array(weights)
    # Residual tokens, documents and attention; first sequence; sequences; tokens used.
    entries = np.empty((0, 6), np.int64)
    out: list[Run] = []
    start = opened = 0
    for length, count in lengths:
        need = np.array((length, 1, length * length), np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while count:
            fits = (entries[:, :3] >= need).all(axis=1)
            if fits.any():
                left = entries[fits, :3]
                if choose == "norm":
                    score = -((((left - need) / full) ** 2) * weight).sum(axis=1)
                else:
                    score = ((left / full) * (need / full) * weight).sum(axis=1)
                row = int(np.flatnonzero(fits)[score.argmax()])
                held = entries[row]
                each = int((held[:3] // need).min())
                taken = min(int(held[4]), max(1, count // each))
                entries = np.delete(entries, row, axis=0)
            else:
                each = int((full // need).min())
                taken = max(1, count // each)
                held = np.array([*full, opened, taken, 0], np.int64)
                opened += taken
            each = min(each, count)
            out.append(Run(start, taken * each, int(held[3]), each, int(held[5]), length))
            used = held.copy()
            used[:3] -= each * need
            used[4], used[5] = taken, held[5] + each * length
            entries = np.vstack([entries, used[None]])
            if taken < held[4]:
                rest = held.copy()
                rest[3], rest[4] = held[3] + taken, held[4] - taken
                entries = np.vstack([entries, rest[None]])
            entries = entries[entries[:, :2].min(axis=1) > 0]
            start += taken * each
            count -= taken * each
    return out


PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
    "offset long"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: Capacity = Capacity(),
    choose: str = "norm",
    weights: tuple[float, float, float] = WEIGHTS,
    with_ids: bool = False,
) -> DataFrame:
    """Every document of ``docs`` (doc_id, text) as pieces placed in sequences.

    Ids end with ``end_id``; a null text is empty. Only a document longer than
    ``capacity.tokens`` is cut, into full pieces after a first that may be shorter.
    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with
    ``with_ids``, ids (little-endian unsigned 32-bit). Null and repeated doc_id are
    documents like others; an empty table gives no rows.
    """
    end = np.array([end_id], "<u4").tobytes()
    most = capacity.tokens * 4
    fields = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ]
    if with_ids:
        fields.append(("ids", pa.binary()))
    schema = pa.schema(fields)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, all_ids in encoded(batches, tokenizer):
            rows: dict[str, list] = {n: [] for n in schema.names}
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), all_ids, strict=True):
                ids += end
                first, start = len(ids) % most or most, 0
                for k, stop in enumerate(range(first, len(ids) + 1, most)):
                    part = ids[start:stop]
                    for name, value in zip(
                        schema.names,
                        (doc_id, k, start // 4, len(part) // 4, zlib.crc32(part), part),
                        strict=False,
                    ):
                        rows[name].append(value)
                    start = stop
            yield emit(schema, **rows)

    ids = ", ids binary" if with_ids else ""
    cutting = "doc_id long, piece int, start long, length long, ids_crc32 long" + ids
    # Written before it is sorted: sorting reads its input twice, once for samples.
    rows = cut(docs.select("doc_id", "text").mapInArrow(pieces, cutting), "pieces")
    rows = in_order(
        rows, F.col("length").desc(), "doc_id", "piece", "ids_crc32", name="pieces"
    )
    histogram = rows.groupBy("length").count().collect()
    lengths = sorted(((r["length"], r["count"]) for r in histogram), reverse=True)
    runs = np.array(vector_best_fit(lengths, capacity, choose, weights), np.int64).reshape(-1, 6)
    shift = firsts(rows)
    out = pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = positions(b.column("at").to_numpy(), None, shift)
            run = runs[np.searchsorted(runs[:, 0], at, "right") - 1]
            turn = at - run[:, 0]
            same = {n: b.column(n) for n in schema.names}
            yield emit(
                out,
                **same,
                sequence_id=run[:, 2] + turn // run[:, 3],
                offset=run[:, 4] + turn % run[:, 3] * run[:, 5],
            )

    return rows.mapInArrow(place, cutting + ", sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_path())
