"""Shards of near equal bytes by best-fit-decreasing bin packing.

Groups (rows with equal text) are indivisible. Taken from the largest down, each
goes into the bin with the tightest remaining capacity that holds it; bins stand
in a balanced tree by what they have left. Groups of one size class are placed
together, so the driver works on a histogram of classes, never on groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import emit, firsts, in_order, positions, table

class Tree:
    """Bins by (remaining capacity, number) in a treap, balanced by hashed priorities."""

    def __init__(self):
        self.root: list | None = None

    @staticmethod
    def _rank(key: tuple[int, int]) -> int:
        return (key[1] * 0x9E3779B97F4A7C15 + key[0] * 0xC2B2AE3D27D4EB4F) % (1 << 64)

    def insert(self, key: tuple[int, int]) -> None:
        self.root = self._insert(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least key with a capacity of at least ``size``."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best

    def _insert(self, node, key):
        if node is None:
            return [key, None, None]
        if self._rank(key) > self._rank(node[0]):
            low, high = self._split(node, key)
            return [key, low, high]
        side = 1 if key < node[0] else 2
        node[side] = self._insert(node[side], key)
        return node

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[2], key)
            node[2] = low
            return node, high
        low, high = self._split(node[1], key)
        node[1] = high
        return low, node

    def _remove(self, node, key):
        if node[0] == key:
            return self._merge(node[1], node[2])
        side = 1 if key < node[0] else 2
        node[side] = self._remove(node[side], key)
        return node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if self._rank(low[0]) > self._rank(high[0]):
            low[2] = self._merge(low[2], high)
            return low
        high[1] = self._merge(low, high[1])
        return high


class Placement(NamedTuple):
    """Groups ``start`` up to ``start + n`` in the order of sizes go to ``bin``."""

    start: int
    n: int
    bin: int


def best_fit(classes: list[tuple[int, int]], capacity: int, bins: list[int]) -> list[Placement]:
    """Place (size, count) classes, largest first, opening bins as they are needed.

    ``bins`` gets the bytes left in each bin. Once a bin took a group it stays the
    tightest until it is full, so a class fills bin after bin.
    """
    tree, out, start = Tree(), [], 0
    for size, count in classes:
        while count:
            found = tree.tightest(size)
            if found is None:
                found = (capacity, len(bins))
                bins.append(capacity)
            else:
                tree.remove(found)
            left, number = found
            n = min(count, left // size)
            bins[number] = left - n * size
            tree.insert((bins[number], number))
            out.append(Placement(start, n, number))
            start += n
            count -= n
    return out


def into_shards(classes: list[tuple[int, int]], shards: int) -> list[Placement]:
    """Near equal shards: the least capacity under which best fit opens at most as many.

    A group larger than an even share of what is left takes a shard of its own,
    and the rest is spread over the others.
    """
    classes, out, start, used = list(classes), [], 0, 0
    total = sum(s * n for s, n in classes)
    while classes and used < shards - 1 and classes[0][0] * (shards - used) > total:
        size, count = classes[0]
        out.append(Placement(start, 1, used))
        start, used, total = start + 1, used + 1, total - size
        classes[0] = (size, count - 1)
        classes = classes[count == 1 :]
    if not classes:
        return out
    low = max(classes[0][0], -(-total // (shards - used)))
    high = low + classes[0][0]
    while len(_bins(classes, high)) > shards - used:
        high *= 2
    while high - low > max(1, low >> 14):
        middle = (low + high) // 2
        if len(_bins(classes, middle)) > shards - used:
            low = middle + 1
        else:
            high = middle
    placed = best_fit(classes, high, [])
    return out + [Placement(p.start + start, p.n, p.bin + used) for p in placed]


def _bins(classes: list[tuple[int, int]], capacity: int) -> list[int]:
    bins: list[int] = []
    best_fit(classes, capacity, bins)
    return bins


def size_class(size) -> F.Column:
    """The size, rounded up to about 12 significant bits.

    So a histogram has at most 4096 classes for each doubling of the size.
    """
    shift = F.greatest(F.lit(0), F.floor(F.log2(size.cast("double"))) - 12).cast("int")
    step = F.pow(F.lit(2.0), shift).cast("long")
    return (F.ceil(size / step) * step).cast("long")


def shard_rows(
    docs: DataFrame, shards: int | None = 8, capacity: int | None = None
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and place there.

    Returns doc_id, size (UTF-8 bytes of the text, none for null, plus 1),
    text_crc32, shard, slot (by doc_id, gapless from 0). Rows of equal text, null
    and empty counting as equal, share a shard. With ``capacity`` instead of
    ``shards`` the shards hold at most so many bytes (by size class) and are as
    few as best fit makes them; a group over it raises. Null and repeated doc_id
    are rows like others; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    groups = rows.groupBy("digest").agg(
        (F.count(F.lit(1)) * F.first("size")).alias("total")
    )
    groups = groups.select("digest", size_class(F.col("total")).alias("total"))
    groups = in_order(groups, F.col("total").desc(), F.col("digest"), name="groups")
    histogram = groups.groupBy("total").count().collect()
    classes = sorted(((r["total"], r["count"]) for r in histogram), reverse=True)
    if capacity is None:
        placed = into_shards(classes, shards or 1)
    else:
        if classes and classes[0][0] > capacity:
            raise ValueError(f"a group of {classes[0][0]} bytes exceeds the capacity")
        placed = best_fit(classes, capacity, [])
    starts = np.array([p.start for p in placed] or [0], np.int64)
    bins = np.array([p.bin for p in placed] or [0], np.int32)
    shift = firsts(groups)
    schema = pa.schema([("digest", pa.binary()), ("shard", pa.int32())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = positions(b.column("at").to_numpy(), None, shift)
            shard = bins[np.searchsorted(starts, at, "right") - 1]
            yield emit(schema, digest=b.column("digest"), shard=shard)

    found = groups.select("digest", "at").mapInArrow(assign, "digest binary, shard int")
    dealt = rows.join(found, "digest").drop("digest")
    dealt = in_order(dealt, "shard", "doc_id", "text_crc32", name="shards")
    offset = firsts(dealt, "shard")
    schema2 = pa.schema([
        ("doc_id", pa.int64()), ("size", pa.int64()), ("text_crc32", pa.int64()),
        ("shard", pa.int32()), ("slot", pa.int64()),
    ])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, shard = b.column("at").to_numpy(), b.column("shard").to_numpy()
            same = {c: b.column(c) for c in ("doc_id", "size", "text_crc32", "shard")}
            yield emit(schema2, **same, slot=positions(at, shard, offset))

    return dealt.mapInArrow(
        number, "doc_id long, size long, text_crc32 long, shard int, slot long"
    )


def query(spark, sf_dir: str) -> DataFrame:
    found = shard_rows(table(spark, sf_dir, "documents"), 8)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
