"""Key checks: repeated grains, missing rows, references without a parent.

Keys are counted before they are shuffled, so a key holding a large share of
the rows travels as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.functions.scalars import listed, literal


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, which have the same columns in the same order."""
    return reduce(DataFrame.union, frames)


def values(spark: SparkSession, rows: Sequence[Sequence], columns: str) -> DataFrame:
    """A small frame of literals; ``columns`` as in ``name, n``."""
    lines = ", ".join(f"({listed(row)})" for row in rows)
    return spark.sql(f"select * from values {lines} as t({columns})")


def repeated_keys(rows: DataFrame, *keys: str, count_as: str = "rows_in_group") -> DataFrame:
    """Key combinations on more than one row, nulls forming a group."""
    return rows.groupBy(*keys).agg(F.expr(f"count(*) as {count_as}")).where(f"{count_as} > 1")


def grain_difference(staged: DataFrame, fact: DataFrame, *keys: str) -> DataFrame:
    """Rows on one side only, labelled with the side that lacks them.

    Both sides are counted per key in one grouping, so a repeated key is added
    up before the shuffle; a key found on one side only comes back once per row.
    A null matches nothing.
    """
    unmatched = " or ".join(f"{k} is null" for k in keys)
    sides = f"""stack(2,
        'missing from fact', if({unmatched} or n_fact = 0, n_staged, 0L),
        'not in staging', if({unmatched} or n_staged = 0, n_fact, 0L)) as (problem, n)"""
    one_sided = (
        staged.selectExpr(*keys, "true as is_staged")
        .union(fact.selectExpr(*keys, "false as is_staged"))
        .groupBy(*keys)
        .agg(
            F.expr("count_if(is_staged) as n_staged"),
            F.expr("count_if(not is_staged) as n_fact"),
        )
        .where(f"n_staged = 0 or n_fact = 0 or {unmatched}")
        .selectExpr(*keys, sides)
        .where("n > 0")
    )
    return repeat_rows(one_sided, "n")


REPEAT_CHUNK = 100_000


def repeat_rows(rows: DataFrame, count: str) -> DataFrame:
    """Every row as many times as its count, which is dropped.

    A large count is cut into chunks that are dealt out by a shuffle of their
    own, so no task writes or holds more than a chunk of one row at a time.
    """
    kept = [c for c in rows.columns if c != count]
    chunks = rows.selectExpr(
        "*", f"explode(sequence(0L, ({count} - 1) div {REPEAT_CHUNK})) as chunk"
    ).repartition(*kept, "chunk")
    size = f"cast(least({count} - chunk * {REPEAT_CHUNK}, {REPEAT_CHUNK}) as int)"
    return chunks.selectExpr(*kept, f"explode(array_repeat(0, {size})) as copy").drop("copy")


def count_references(
    scans: Sequence[tuple[DataFrame, Mapping[str, tuple[str, str]]]],
    parents: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """Rows that set each reference, and rows of those that no parent resolves.

    ``scans`` pairs a frame with its references, name to (column, parent);
    ``parents`` maps a parent to (frame, key column). Result: reference, n_set,
    n_unresolved; every reference has a row.

    References and parent keys meet in one grouping by key, without a join:
    each frame is scanned once, and rows of the same key are added up before
    the shuffle, so neither a popular parent nor a repeated key weighs on one
    task.
    """
    number = {parent: i for i, parent in enumerate(parents)}
    slots: dict[str, list[str]] = {parent: [] for parent in parents}

    def use(parent: str, slot: int, column: str) -> str:
        return f"{number[parent]}, {slot}, cast(`{column}` as string)"

    def tagged(rows: DataFrame, uses: list[str]) -> DataFrame:
        return rows.selectExpr(f"stack({len(uses)}, {', '.join(uses)}) as (parent, slot, key)")

    parts = []
    for rows, references in scans:
        uses = []
        for name, (column, parent) in references.items():
            uses.append(use(parent, len(slots[parent]), column))
            slots[parent].append(name)
        parts.append(tagged(rows, uses))
    parts += [tagged(rows, [use(parent, -1, key)]) for parent, (rows, key) in parents.items()]

    width = max(len(names) for names in slots.values())
    per_key = (
        union_all(parts)
        .where("key is not null")
        .groupBy("parent", "key")
        .agg(
            F.expr("max(slot < 0) as found"),
            *[F.expr(f"count_if(slot = {i}) as n{i}") for i in range(width)],
        )
    )
    sums = []
    for i in range(width):
        sums += [
            F.expr(f"sum(n{i}) as set{i}"),
            F.expr(f"coalesce(sum(if(found, 0, n{i})), 0) as lost{i}"),
        ]
    names = ", ".join(
        "array("
        + ", ".join(literal(n) for n in slots[p] + [None] * (width - len(slots[p])))
        + ")"
        for p in parents
    )
    by_slot = ", ".join(f"names[parent][{i}], set{i}, lost{i}" for i in range(width))
    every = [(name, 0, 0) for found in slots.values() for name in found]
    return (
        per_key.groupBy("parent")
        .agg(*sums)
        .selectExpr("*", f"array({names}) as names")
        .selectExpr(f"stack({width}, {by_slot}) as (reference, n_set, n_unresolved)")
        .where("reference is not null")
        .union(values(scans[0][0].sparkSession, every, "reference, n_set, n_unresolved"))
        .groupBy("reference")
        .agg(F.expr("sum(n_set) as n_set"), F.expr("sum(n_unresolved) as n_unresolved"))
    )
