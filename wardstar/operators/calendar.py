"""A calendar with one row per day between two bounds found in the data."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardstar.functions.scalars import date_key, day


def daily_series(rows: DataFrame, moment: str) -> DataFrame:
    """Every day from the first to the last moment, both included."""
    first, last = day(f"min({moment})"), day(f"max({moment})")
    return rows.selectExpr(f"sequence({first}, {last}, interval 1 day) as days").selectExpr(
        "explode(days) as calendar_date"
    )


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``calendar_date``; weeks are ISO weeks."""
    return (
        days.selectExpr(
            "calendar_date",
            "cast(extract(yearofweek from calendar_date) as bigint) as iso_year",
            "cast(weekofyear(calendar_date) as bigint) as iso_week",
            "cast(weekday(calendar_date) + 1 as bigint) as day_of_week",
        )
        .selectExpr(
            f"{date_key('calendar_date')} as date_id",
            "calendar_date",
            "cast(year(calendar_date) as bigint) as calendar_year",
            "cast(quarter(calendar_date) as bigint) as calendar_quarter",
            "cast(month(calendar_date) as bigint) as calendar_month",
            "date_format(calendar_date, 'MMMM') as month_name",
            "date_format(calendar_date, 'yyyy-MM') as year_month",
            "cast(dayofmonth(calendar_date) as bigint) as day_of_month",
            "day_of_week",
            "date_format(calendar_date, 'EEEE') as day_name",
            "iso_year",
            "iso_week",
            "iso_year * 100 + iso_week as iso_year_week",
            "day_of_week >= 6 as is_weekend",
        )
    )
