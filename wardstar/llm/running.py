"""Running sums over rows sorted across all partitions, however large one group is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from wardstar.llm.common import cut

MASK = (1 << 64) - 1


def raised(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent, modulo 2^64."""
    out = np.ones(len(exponents), np.uint64)
    left = exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(base), out)
        base = base * base & MASK
        left = left >> np.uint64(1)
    return out


def running(
    rows: DataFrame, group: str, order: list[Column], values: list[str], base: int = 1, name: str = "running"
) -> DataFrame:
    """The rows with ``place``, their number in the group from 0, and sums up to them.

    Rows are sorted by ``group`` (a long that is never null) and then by ``order``.
    For a value column v, ``v_before`` is the sum over earlier rows of the group and
    ``v_sum`` the sum with this row, modulo 2^64; each term is multiplied by ``base``
    to the power of its place.

    A group may lie in many partitions: each partition sums its own rows, the driver
    gets one row per partition, and what came before is added where a group goes on.
    """
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    schema = StructType(list(ordered.schema.fields)).add("part", IntegerType()).add("place", LongType())
    for v in values:
        schema = schema.add(f"{v}_before", LongType()).add(f"{v}_sum", LongType())
    kept = len(ordered.schema.fields)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen, sums = None, 0, dict.fromkeys(values, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(group).to_numpy()
            opens = np.flatnonzero(np.concatenate(([keys[0] != last], keys[1:] != keys[:-1])))
            goes_on = 0 if len(opens) and opens[0] == 0 else 1
            starts = np.concatenate(([0], opens)) if goes_on else opens
            lengths = np.diff(np.append(starts, n))
            place = np.arange(n) - np.repeat(starts, lengths)
            if goes_on:
                place[: lengths[0]] += seen
            factor = raised(base, place) if base != 1 else np.uint64(1)
            out = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(place)]
            for v in values:
                terms = batch.column(v).to_numpy().view(np.uint64) * factor
                total = np.cumsum(terms)
                skip = (total - terms)[starts]
                if goes_on:
                    skip[:1] -= np.uint64(sums[v])
                total -= np.repeat(skip, lengths)
                sums[v] = int(total[-1])
                out += [pa.array((total - terms).view(np.int64)), pa.array(total.view(np.int64))]
            last, seen = keys[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    found = cut(ordered.mapInArrow(local, schema), name)
    carried = _carried(found, group, values, base)
    if not carried:
        return found.drop("part")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            keys, parts = batch.column(group).to_numpy(), batch.column("part").to_numpy()
            place = batch.column("place").to_numpy().copy()
            sums = [c.to_numpy().view(np.uint64).copy() for c in columns[kept + 2 :]]
            for part in np.intersect1d(parts, list(carried)):
                first, count, before = carried[int(part)]
                here = (parts == part) & (keys == first)
                place[here] += count
                factor = np.uint64(pow(base, count, 1 << 64))
                for k, s in enumerate(sums):
                    s[here] = s[here] * factor + np.uint64(before[k // 2])
            columns[kept + 1] = pa.array(place)
            columns[kept + 2 :] = [pa.array(s.view(np.int64)) for s in sums]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return found.mapInArrow(whole, schema).drop("part")


def _carried(found: DataFrame, group: str, values: list[str], base: int) -> dict:
    """For partitions that open inside a group: the group, rows before, and sums before."""
    last = F.max(F.struct(group, "place", *(f"{v}_sum" for v in values))).alias("last")
    parts = found.groupBy("part").agg(F.min(group).alias("first"), last).collect()
    carried: dict[int, tuple] = {}
    before = None
    for row in sorted(parts, key=lambda r: r.part):
        key, place, *sums = row.last
        count, sums = place + 1, [s & MASK for s in sums]
        if before and before[0] == row.first:
            carried[row.part] = before
            if key == row.first:
                factor = pow(base, before[1], 1 << 64)
                sums = [(s * factor + b) & MASK for s, b in zip(sums, before[2], strict=True)]
                count += before[1]
        before = (key, count, sums)
    return carried
