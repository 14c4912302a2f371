"""One deterministic label per code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_label(
    rows: DataFrame, code: str, label: str, *, spellings_as: str, rows_as: str
) -> DataFrame:
    """The label on most rows of each code, ties to the first in text order.

    Also gives the spellings and rows behind it. Rows are counted per spelling
    before anything is grouped by code, and the choice is a minimum rather than
    a ranking window, so a code holding most of the rows reaches its reducer as
    a few partial results instead of as one big sorted group. Row order has no
    influence. A null label sorts last.
    """
    return (
        rows.groupBy(code, label)
        .agg(F.expr("count(*) as uses"))
        .groupBy(code)
        .agg(
            F.expr(f"min(struct(-uses, {label} is null, {label} as label)) as best"),
            F.expr(f"count(*) as {spellings_as}"),
            F.expr(f"sum(uses) as {rows_as}"),
        )
        .selectExpr(code, f"best.label as {label}", spellings_as, rows_as)
    )


def label_and_members(
    rows: DataFrame, code: str, label: str, member: str, *, spellings_as: str, rows_as: str, members_as: str
) -> DataFrame:
    """``canonical_label`` with the distinct members of each code, nulls not counted.

    Two grouping sets, (code, label) and (code, member), count both in one scan and
    one shuffle of the rows, added up per task before it. What moves afterwards is one
    partial result per task and code.
    """
    spelled = "is_member = 0"
    return (
        rows.groupingSets([[F.col(code), F.col(label)], [F.col(code), F.col(member)]], code, label, member)
        .agg(F.expr("count(*) as uses"), F.expr(f"grouping({label}) as is_member"))
        .groupBy(code)
        .agg(
            F.expr(
                f"min(if({spelled}, struct(-uses as uses, {label} is null as unlabelled, "
                f"{label} as label), null)) as best"
            ),
            F.expr(f"count_if({spelled}) as {spellings_as}"),
            F.expr(f"sum(if({spelled}, uses, 0)) as {rows_as}"),
            F.expr(f"count({member}) as {members_as}"),
        )
        .selectExpr(code, f"best.label as {label}", spellings_as, rows_as, members_as)
    )
