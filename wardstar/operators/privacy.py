"""Which patients the published dates put over 89, and what that withholds."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.scalars import completed_years, day, plus_years
from wardstar.operators.keys import union_all

class Publication(NamedTuple):
    """One place that publishes dates about a patient, and perhaps ages at them.

    ``dates`` are SQL over the staged table and, where there is a ``fact``, over the
    fact as well, first date first. ``label`` and ``row_key`` name the fact and its
    rows in what the rules report.
    """

    staged: str
    dates: tuple[str, ...]
    fact: str | None = None
    label: str = ""
    row_key: str = ""


# Every date and age the star publishes about a patient. The cohort, the
# bounds and all rules on ages follow this list; a table that publishes another belongs here.
PUBLICATIONS: tuple[Publication, ...] = (
    Publication("stg_patients", ("death_date",)),
    Publication(
        "stg_encounters",
        (day("started_at"), day("stopped_at")),
        "fct_encounter",
        "encounter",
        "encounter_id",
    ),
    Publication(
        "stg_conditions",
        ("started_date", "stopped_date"),
        "fct_condition",
        "condition",
        "concat(patient_id, '|', condition_code)",
    ),
)
PUBLISHED_DATES: dict[str, tuple[str, ...]] = {p.staged: p.dates for p in PUBLICATIONS}
#: The facts that publish an age, as ``patient_age_years`` at their first date.
AGED_FACTS: tuple[Publication, ...] = tuple(p for p in PUBLICATIONS if p.fact)


def published_dates(tables: dict[str, DataFrame]) -> DataFrame:
    """Each published date as one row (patient_id, published_date)."""
    return union_all(
        [
            tables[name].selectExpr(
                "patient_id",
                f"explode(array_compact(array({', '.join(dates)}))) as published_date",
            )
            for name, dates in PUBLISHED_DATES.items()
        ]
    )


def last_seen(tables: dict[str, DataFrame]) -> DataFrame:
    """Latest published date per patient, null for none.

    Takes the later of a row's dates before grouping, so every table is scanned
    once and contributes one value per row. The partial maximum is taken before
    the shuffle, so one patient holding most rows costs one row per task.
    """

    def latest(dates: tuple[str, ...]) -> str:
        return f"greatest({', '.join(dates)})" if len(dates) > 1 else dates[0]

    parts = [
        tables[name].selectExpr("patient_id", f"{latest(dates)} as published_date")
        for name, dates in PUBLISHED_DATES.items()
    ]
    return (
        union_all(parts)
        .groupBy("patient_id")
        .agg(F.expr("max(published_date) as last_published_date"))
    )


def attained_age(patients: DataFrame, seen: DataFrame) -> DataFrame:
    """Patients with the greatest age any published date reveals.

    A patient without a date counts as alive until the last date of the data.
    ``seen`` is read twice, so pass it as a written table.
    """
    data_end = seen.agg(F.expr("max(last_published_date)")).scalar()
    until = "coalesce(last_published_date, data_end)"
    return (
        patients.join(seen, "patient_id", "left")
        .withColumn("data_end", data_end)
        .withColumn("max_attained_age", F.expr(completed_years("birth_date", until)))
        .drop("last_published_date", "data_end")
    )


def protected_cohort(dim_patient: DataFrame) -> DataFrame:
    """Keys of the patients whose ages and years are withheld."""
    return dim_patient.where("is_age_90_or_older").select("patient_id")


def flagged_cohort(dim_patient: DataFrame) -> DataFrame:
    """The cohort with a flag to tell a match of a left join by."""
    return protected_cohort(dim_patient).selectExpr("patient_id", "true as is_protected")


def age_guard(patients: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """Birth date per patient, null for a protected one.

    Facts take their age from this one lookup, so they are joined to patients
    once and never see the birth date of a protected patient.
    """
    return (
        patients.select("patient_id", "birth_date")
        .join(flagged_cohort(dim_patient), "patient_id", "left")
        .selectExpr("patient_id", "if(is_protected is null, birth_date, null) as open_birth_date")
    )


def published_periods(tables: Callable[[str], DataFrame]) -> DataFrame:
    """One row per fact row: fact, patient, first and last date it publishes, age.

    The age on a fact belongs to the first of its dates.
    """
    return union_all(
        [
            tables(p.fact).selectExpr(
                f"'{p.fact}' as fact",
                "patient_id",
                f"{p.dates[0]} as from_date",
                f"{p.dates[-1]} as to_date",
                "patient_age_years",
            )
            for p in AGED_FACTS
        ]
    )


#: The earliest birth that an age at a fact's first date leaves possible is not
#: before this day; the earlier it is, the older the patient at any later date.
BIRTH_BOUND = plus_years("from_date", "-patient_age_years")


def patient_marks(periods: DataFrame) -> DataFrame:
    """One row per patient of the facts: what bounds every date rule about them.

    The latest published date, the latest encounter start, the earliest birth bound,
    and rows with and without an age. A rule about ages grows with the date, so the
    patients that can break it are known from these bounds, before any fact row
    moves. All of them are partial aggregates: a patient with most rows costs one
    row per task.
    """
    return periods.groupBy("patient_id").agg(
        F.expr("max(greatest(from_date, to_date)) as latest_date"),
        F.expr("max(if(fact = 'fct_encounter', from_date, null)) as latest_encounter"),
        F.expr(f"min({BIRTH_BOUND}) as birth_bound"),
        F.expr("count(patient_age_years) as n_with_age"),
        F.expr("count_if(patient_age_years is null) as n_without_age"),
    )


def periods_of(periods: DataFrame, patients: DataFrame) -> DataFrame:
    """The periods of some patients, counted: equal ones are one row with ``n``.

    Only rows of these patients reach the grouping.
    """
    kept = periods.join(patients.select("patient_id").distinct(), "patient_id", "left_semi")
    return kept.groupBy(*periods.columns).agg(F.expr("count(*) as n"))
