"""A ledger of keys: how often each key value stands in each place that uses it.

Rules about keys (unique, resolved, same grain on both sides) ask the same thing
of the same columns: which values occur, and how often, here and there. One grouping
by (domain, key) answers all of them. Columns whose values mean the same thing
share a domain; each use of it has a slot. Rows of one key are added up before the
shuffle, so a popular key weighs on no task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.scalars import listed
from wardstar.operators.keys import union_all


class Use(NamedTuple):
    """One place that uses keys of a domain: a table and its key, as SQL text."""

    table: str
    domain: str
    key: str


class KeyFigure(NamedTuple):
    """A number per key, summed over a domain; ``{name}`` is the count of a use."""

    domain: str
    per_key: str


def layout(uses: Mapping[str, Use]) -> dict[str, list[str]]:
    """By domain, its uses in the order of their slots."""
    found: dict[str, list[str]] = {}
    for name, use in uses.items():
        found.setdefault(use.domain, []).append(name)
    return found


def key_ledger(tables: Callable[[str], DataFrame], uses: Mapping[str, Use]) -> DataFrame:
    """One row for each domain (by number) and key, with the uses counted by slot.

    Every table is scanned once, for its key columns only. Null keys are left out.
    """
    domains = layout(uses)
    number = {domain: i for i, domain in enumerate(domains)}
    by_table: dict[str, list[str]] = {}
    for name, use in uses.items():
        slot = domains[use.domain].index(name)
        by_table.setdefault(use.table, []).append(
            f"{number[use.domain]}, {slot}, cast({use.key} as string)"
        )
    parts = [
        tables(table).selectExpr(f"stack({len(tagged)}, {', '.join(tagged)}) as (domain, slot, key)")
        for table, tagged in by_table.items()
    ]
    width = max(len(names) for names in domains.values())
    return (
        union_all(parts)
        .where("key is not null")
        .groupBy("domain", "key")
        .agg(*[F.expr(f"count_if(slot = {i}) as n{i}") for i in range(width)])
    )


def key_figures(
    ledger: DataFrame, uses: Mapping[str, Use], figures: Mapping[str, KeyFigure]
) -> DataFrame:
    """(name, n) of every figure whose domain has keys: one pass over the ledger."""
    domains = layout(uses)
    by_domain: dict[str, list[tuple[str, str]]] = {domain: [] for domain in domains}
    for name, figure in figures.items():
        slots = {use: f"n{i}" for i, use in enumerate(domains[figure.domain])}
        per_key = figure.per_key
        for use, column in slots.items():
            per_key = per_key.replace("{" + use + "}", column)
        by_domain[figure.domain].append((name, per_key))
    width = max(map(len, by_domain.values()))
    sums = []
    for j in range(width):
        cases = "".join(
            f"when {i} then {found[j][1]} " for i, found in enumerate(by_domain.values()) if j < len(found)
        )
        sums.append(F.expr(f"sum(case domain {cases}else 0L end) as f{j}"))
    names = ", ".join(
        f"array({listed([name for name, _ in found] + [None] * (width - len(found)))})"
        for found in by_domain.values()
    )
    return (
        ledger.groupBy("domain")
        .agg(*sums)
        .selectExpr("array(" + names + ")[domain] as names", *[f"f{j}" for j in range(width)])
        .selectExpr(
            f"stack({width}, {', '.join(f'names[{j}], f{j}' for j in range(width))}) as (name, n)"
        )
        .where("name is not null")
    )
