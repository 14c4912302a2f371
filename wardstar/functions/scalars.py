"""Scalar expressions shared by the models, rules and reports.

Each takes SQL expressions as text and returns one, for ``selectExpr``,
``where`` or ``spark.sql``. Text keeps building a plan of hundreds of rules
cheap, and Catalyst sees plain built-in functions. None reads the clock or the
session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable

from wardstar.functions.fixed import (
    OTHER_PAYER_CLASS,
    PAYER_CLASSES,
    PROTECTED_AGE,
    PUBLIC_PAYER_CLASSES,
    RESTRICTED_ZIP3,
)


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value: str | int | bool | None) -> str:
    if value is None:
        return "null"
    return text(value) if isinstance(value, str) else str(value).lower()


def listed(values: Iterable[str | int]) -> str:
    """Literals for an IN list."""
    return ", ".join(literal(v) for v in values)


def day(moment: str) -> str:
    """Calendar day of a zone-free timestamp."""
    return f"cast({moment} as date)"


def date_key(date: str) -> str:
    """YYYYMMDD as an integer."""
    return f"(year({date}) * 10000 + month({date}) * 100 + dayofmonth({date}))"


def completed_years(start: str, end: str) -> str:
    """Whole years passed from start to end, negative when end is earlier.

    The difference of two YYYYMMDD numbers holds the years in its ten-thousands
    and borrows one exactly when the birthday has not come yet, so rounding it
    down is the age. months_between rounds 29 February up and timestampdiff
    truncates towards zero; both differ from this.
    """
    return f"floor(({date_key(end)} - {date_key(start)}) / 10000)"


def _second_of_day(moment: str) -> str:
    return f"(hour({moment}) * 3600 + minute({moment}) * 60 + second({moment}))"


def elapsed_seconds(start: str, stop: str) -> str:
    """Seconds between two zone-free timestamps, fractions cut off first."""
    days = f"datediff({day(stop)}, {day(start)})"
    return f"({days} * 86400L + {_second_of_day(stop)} - {_second_of_day(start)})"


def whole_minutes(start: str, stop: str) -> str:
    """Completed minutes of elapsed time."""
    return f"({elapsed_seconds(start, stop)} div 60)"


def days_between(start: str, end: str) -> str:
    """Midnights from start to end."""
    return f"cast(datediff({end}, {start}) as bigint)"


def plus_years(date: str, years: str | int) -> str:
    """The same day in another year; 29 February becomes the 28th."""
    return f"add_months({date}, cast(12 * ({years}) as int))"


def trailing_tag(label: str) -> str:
    """Text of a closing parenthetical, null without one.

    The anchor is the very end of the text: a final newline is not skipped.
    """
    return rf"nullif(regexp_extract({label}, r'\(([^()]+)\)\z', 1), '')"


def collapse_whitespace(value: str) -> str:
    """Runs of whitespace become one space, none is left at the ends."""
    return rf"trim(regexp_replace({value}, r'[\t\n\f\r ]+', ' '))"


def zip_prefix(zip_code: str) -> str:
    """First three characters, or 000 for a restricted prefix."""
    prefix = f"substr({zip_code}, 1, 3)"
    return f"if({prefix} in ({listed(RESTRICTED_ZIP3)}), '000', {prefix})"


def is_zip_prefix(value: str) -> str:
    """True for exactly three digits."""
    return rf"({value} rlike r'\A[0-9]{{3}}\z')"


# The shapes raw ZIP codes arrive in, by the pattern of the whole text.
ZIP_SHAPES = {
    "ZIP+4": r"[0-9]{5}-[0-9]{4}",
    "five digits": r"[0-9]{5}",
    "four digits": r"[0-9]{4}",
}


def zip_shape(value: str) -> str:
    """Which shape a raw ZIP code has; null for none, ``other`` for any text else."""
    known = "".join(
        f"when {value} rlike r'\\A{pattern}\\z' then {text(shape)} "
        for shape, pattern in ZIP_SHAPES.items()
    )
    return f"case when {value} is null then null {known}else 'other' end"


def payer_class(name: str) -> str:
    """Financial class of a payer name."""
    named = listed(x for pair in PAYER_CLASSES.items() for x in pair)
    return f"coalesce(try_element_at(map({named}), {name}), {text(OTHER_PAYER_CLASS)})"


def payer_rollup(financial_class: str) -> str:
    """Category of a financial class: the public programs become one."""
    public = f"{financial_class} in ({listed(PUBLIC_PAYER_CLASSES)})"
    return f"if({public}, 'public', {financial_class})"


def is_protected_age(age: str) -> str:
    return f"({age} >= {PROTECTED_AGE})"


def unless_protected(age: str, value: str) -> str:
    """value where the age is known and below the protected category.

    Fails closed: an unknown age withholds the value as well.
    """
    return f"if({age} < {PROTECTED_AGE}, {value}, null)"
