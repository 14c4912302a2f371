"""Feed profiles: keys, references, children, mixing, population, totals.

Every operator counts keys before it shuffles them. Lookups join distinct key
lists, so a repeated key in one feed cannot multiply the rows of another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.scalars import text
from wardstar.operators.keys import count_references

NULL_LABEL = "(null)"
MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def money_sum(amount: str) -> str:
    """Money added up exactly, at a width no total outgrows."""
    return f"cast(sum(cast({amount} as {MONEY})) as {MONEY_SUM})"


def key_profile(rows: DataFrame, key: str) -> DataFrame:
    """One row: n_rows, n_distinct, n_null of a key column."""
    return (
        rows.groupBy(F.expr(f"`{key}` as key"))
        .agg(F.expr("count(*) as n"))
        .agg(
            F.expr("coalesce(sum(n), 0) as n_rows"),
            F.expr("count(key) as n_distinct"),
            F.expr("coalesce(sum(if(key is null, n, 0)), 0) as n_null"),
        )
    )


def reference_profile(
    rows: DataFrame,
    references: Mapping[str, tuple[str, str]],
    parents: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """References of one feed: reference, n_set, n_unresolved."""
    return count_references([(rows, references)], parents)


def children_per_parent(
    parents: DataFrame,
    parent_key: str,
    children: DataFrame,
    child_key: str,
    categories: Sequence[str] = (),
) -> DataFrame:
    """Children of every distinct parent key, zero included.

    Columns: parent, n_children, and ``<category>_mixes`` for each category:
    whether the parent's children carry more than one value of it, null being a
    value of its own. Mixing is found by comparing the smallest with the largest
    value, which merges across tasks and needs no distinct set.
    """
    extremes = []
    for c in categories:
        label = f"coalesce(`{c}`, {text(NULL_LABEL)})"
        extremes += [f"min({label}) as {c}_low", f"max({label}) as {c}_high"]
    per_key = (
        children.where(f"`{child_key}` is not null")
        .groupBy(F.expr(f"`{child_key}` as parent"))
        .agg(F.expr("count(*) as n"), *[F.expr(e) for e in extremes])
    )
    keys = parents.selectExpr(f"`{parent_key}` as parent").distinct()
    return keys.join(per_key, "parent", "left").selectExpr(
        "parent",
        "coalesce(n, 0) as n_children",
        *[f"coalesce({c}_low != {c}_high, false) as {c}_mixes" for c in categories],
    )


def children_summary(per_parent: DataFrame) -> DataFrame:
    """One row: parents, those without a child, with one, and the most."""
    mixes = [c for c in per_parent.columns if c.endswith("_mixes")]
    return per_parent.agg(
        F.expr("count(*) as n_parents"),
        F.expr("count_if(n_children = 0) as n_without"),
        F.expr("count_if(n_children = 1) as n_with_one"),
        F.expr("max(n_children) as most_children"),
        *[F.expr(f"count_if({c}) as n_{c}") for c in mixes],
    )


def population_by_category(
    rows: DataFrame, category: str, columns: Sequence[str], amount: str
) -> DataFrame:
    """Per category: rows, rows filling each column, and one amount summed."""
    return rows.groupBy(category).agg(
        F.expr("count(*) as n_rows"),
        *[F.expr(f"count(`{c}`) as with_{c}") for c in columns],
        F.expr(f"{money_sum(amount)} as amount_total"),
    )


def totals(rows: DataFrame, amounts: Mapping[str, str]) -> DataFrame:
    """Rows and money sums of one feed: (measure, n_rows, amount)."""
    sums = [F.expr(f"{money_sum(a)} as a{i}") for i, a in enumerate(amounts.values())]
    lines = ", ".join(f"{text(name)}, n_rows, a{i}" for i, name in enumerate(amounts))
    return rows.agg(F.expr("count(*) as n_rows"), *sums).selectExpr(
        f"stack({len(amounts)}, {lines}) as (measure, n_rows, amount)"
    )


def reconciliation(left: DataFrame, right: DataFrame, left_as: str, right_as: str) -> DataFrame:
    """Two ``totals`` side by side per measure, with their difference."""
    a = left.selectExpr("measure", f"amount as {left_as}")
    b = right.selectExpr("measure", f"amount as {right_as}")
    gap = f"coalesce({left_as}, 0) - coalesce({right_as}, 0)"
    return a.join(b, "measure", "full_outer").selectExpr(
        "*", f"cast({gap} as {MONEY_SUM}) as difference"
    )
