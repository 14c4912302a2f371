"""Written cuts, gapless positions and Arrow helpers the operators share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.sources.tables import shared_folder

#: Bytes of text that one step of a Python worker holds as numbers.
STEP_BYTES = 1 << 20
#: The bits of ``monotonically_increasing_id`` that count rows of a partition.
ROW_BITS = 33
#: Spark's setting that deletes an execution's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and every executor reach."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written to the shared folder and read back, and where.

    Cuts the lineage: what is read more than once is computed once, and a lost
    executor costs no recomputation of what was written before. The write is the only
    reader of its shuffles, so their files go when it ends; broadcasts go when the
    driver has collected the plan as garbage, which it is asked to do.
    """
    spark = rows.sparkSession
    path = work_folder(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    schema = rows.schema
    del rows
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path), path


def cut(rows: DataFrame, name: str) -> DataFrame:
    """``written`` for rows whose folder stays."""
    return written(rows, name)[0]


def partitions(spark: SparkSession) -> int:
    """How many parts keys are dealt to: the user's own shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(rows: DataFrame, size: int, per_task: int = 1 << 26) -> DataFrame:
    """A small table of work orders dealt to tasks by the bytes they ask to read.

    The number is given, because adaptive execution sees only how small the orders
    are and would give all of them to one task.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-size // per_task)))


def in_order(rows: DataFrame, *keys, name: str = "ordered") -> DataFrame:
    """The rows sorted over all partitions and written, with ``at``.

    ``at`` grows in the order of the keys; positions follow from it by the first
    ``at`` of each partition (see ``firsts``).
    """
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut(ordered.withColumn("at", F.monotonically_increasing_id()), name)


def firsts(rows: DataFrame, group: str | None = None) -> dict[tuple[int, object], int]:
    """What to add to ``at`` to get gapless positions, by (partition, group).

    The driver gets one row per partition, or per partition and group in it; in
    rows ordered by the group first that is at most partitions plus groups.
    """
    part = F.shiftright("at", ROW_BITS).alias("part")
    key = F.col(group) if group else F.lit(0)
    found = rows.groupBy(part, key.alias("key")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    )
    shift: dict[tuple[int, object], int] = {}
    seen: dict[object, int] = {}
    for row in sorted(found.collect(), key=lambda r: r.part):
        shift[row.part, row.key] = seen.get(row.key, 0) - row.first
        seen[row.key] = seen.get(row.key, 0) + row.n
    return shift


def positions(at: np.ndarray, group: np.ndarray | None, shift: dict) -> np.ndarray:
    """Gapless positions for the values of ``at`` in one batch."""
    part = at >> ROW_BITS
    key = np.zeros_like(part) if group is None else group
    out = np.empty(len(at), np.int64)
    start = 0
    while start < len(at):
        # Written rows keep their order, so equal pairs stand together.
        same = (part[start:] == part[start]) & (key[start:] == key[start])
        stop = len(at) if same.all() else start + int(same.argmin())
        out[start:stop] = at[start:stop] + shift[int(part[start]), int(key[start])]
        start = stop
    return out


def texts(
    batches: Iterator[pa.RecordBatch], size: int = STEP_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the UTF-8 of column ``text`` (null: empty).

    A slice holds at most ``size`` bytes of text, or one longer document.
    """
    for batch in batches:
        column = batch.column("text")
        if not pa.types.is_string(column.type):
            column = column.cast(pa.string())
        lengths = np.asarray(
            pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64
        )
        start = 0
        while start < batch.num_rows:
            ends = np.cumsum(lengths[start:])
            n = max(1, int(np.searchsorted(ends, size, "right")))
            piece = batch.slice(start, n)
            values = column.slice(start, n).cast(pa.binary()).to_pylist()
            yield piece, [v or b"" for v in values]
            start += n


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each span, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def emit(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
