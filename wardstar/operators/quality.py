"""Generic rules (not null, unique, relationships, accepted values) and severity.

A set of rules of one kind is answered together: every table contributes only
its failures, already reduced per task, and one grouping adds them up per rule.
Conditions are SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.functions.scalars import listed, text
from wardstar.operators.keys import count_references, union_all, values


def failures(rows: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """One row (name, n) per condition a row meets.

    Rows meeting none are filtered out first. Where all conditions are null
    checks the filter reaches the Parquet scan, which then skips every row
    group whose statistics show no nulls.
    """
    met = ", ".join(f"if({c}, {text(name)}, null)" for name, c in conditions.items())
    return rows.where(" or ".join(f"({c})" for c in conditions.values())).selectExpr(
        f"explode(array_compact(array({met}))) as name", "1L as n"
    )


def nulls(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """(name, n) for every null; ``names`` maps a rule name to its column."""
    return failures(rows, {name: f"`{c}` is null" for name, c in names.items()})


def repeats(scans: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """(name, n) for every value on more than one row; nulls are ignored.

    All columns of all tables share one grouping by rule and value.
    """
    names: list[str] = []
    parts = []
    for rows, columns in scans:
        keyed = []
        for name, column in columns.items():
            keyed.append(f"{len(names)}, cast(`{column}` as string)")
            names.append(name)
        stacked = f"stack({len(keyed)}, {', '.join(keyed)}) as (rule, value)"
        parts.append(rows.selectExpr(stacked))
    return (
        union_all(parts)
        .where("value is not null")
        .groupBy("rule", "value")
        .agg(F.expr("count(*) as uses"))
        .where("uses > 1")
        .selectExpr(f"array({listed(names)})[rule] as name", "1L as n")
    )


def orphans(
    scans: Sequence[tuple[DataFrame, Mapping[str, tuple[str, str]]]],
    parents: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """(name, n) with the child rows no parent resolves."""
    return count_references(scans, parents).selectExpr("reference as name", "n_unresolved as n")


def outsiders(rows: DataFrame, accepted: Mapping[str, tuple[str, Sequence]]) -> DataFrame:
    """(name, value) for every non-null value outside the list of its rule.

    ``accepted`` maps a rule name to (column, values).
    """
    outside = {n: f"`{c}` not in ({listed(allowed)})" for n, (c, allowed) in accepted.items()}
    found = ", ".join(
        f"if({outside[n]}, struct({text(n)}, cast(`{c}` as string)), null)"
        for n, (c, _) in accepted.items()
    )
    return rows.where(" or ".join(outside.values())).selectExpr(
        f"inline(array_compact(array({found}))) as (name, value)"
    )


def distinct_outsiders(found: DataFrame) -> DataFrame:
    """(name, n) once per distinct value."""
    return found.distinct().selectExpr("name", "1L as n")


def tally(spark: SparkSession, names: Sequence[str], parts: Sequence[DataFrame]) -> DataFrame:
    """(name, violations) of every rule, zero included, from (name, n) rows."""
    zeros = values(spark, [(n, 0) for n in names], "name, n")
    return union_all([*parts, zeros]).groupBy("name").agg(F.expr("sum(n) as violations"))


def status(violations: str, warn_if: str, error_if: str) -> str:
    """pass, warn or error: more violations than a threshold trip it."""
    return (
        f"case when {violations} > {error_if} then 'error' "
        f"when {violations} > {warn_if} then 'warn' else 'pass' end"
    )


def to_long(one_row: DataFrame, labels: Sequence[str], *, key_as: str, value_as: str) -> DataFrame:
    """A one-row frame turned into one row per column, in column order."""
    pairs = ", ".join(
        f"{text(label)}, `{column}`"
        for label, column in zip(labels, one_row.columns, strict=True)
    )
    return one_row.selectExpr(f"stack({len(labels)}, {pairs}) as ({key_as}, {value_as})")
