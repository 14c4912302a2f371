"""The two facts. Neither filters: a row is lost only with its parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.scalars import (
    completed_years,
    date_key,
    day,
    days_between,
    whole_minutes,
)


def fct_encounter(
    stg_encounters: DataFrame, stg_conditions: DataFrame, age_guard: DataFrame
) -> DataFrame:
    """One row per encounter.

    Conditions are counted per encounter before the join, and birth date and
    protection arrive in one lookup, so the encounters move twice at most: once
    by encounter and once by patient.
    """
    per_encounter = stg_conditions.groupBy("encounter_id").agg(
        F.expr("count(*) as recorded_conditions")
    )
    started = day("started_at")
    stay = days_between(started, day("stopped_at"))
    return (
        stg_encounters.join(per_encounter, "encounter_id", "left")
        .join(age_guard, "patient_id")
        .selectExpr(
            "encounter_id",
            f"{date_key(started)} as date_id",
            "patient_id",
            "organization_id",
            "provider_id",
            "payer_id",
            "encounter_code",
            "encounter_class",
            "reason_code",
            "reason_description",
            "started_at",
            "stopped_at",
            f"{whole_minutes('started_at', 'stopped_at')} as duration_minutes",
            f"if(encounter_class = 'inpatient', {stay}, null) as length_of_stay_days",
            f"{completed_years('open_birth_date', started)} as patient_age_years",
            "coalesce(recorded_conditions, 0) as condition_count",
            "base_encounter_cost",
            "total_claim_cost",
            "payer_coverage",
            "total_claim_cost - payer_coverage as uncovered_amount",
        )
    )


def fct_condition(
    stg_conditions: DataFrame, stg_encounters: DataFrame, age_guard: DataFrame
) -> DataFrame:
    """One row per condition recorded for a patient at an encounter."""
    encounter_days = stg_encounters.selectExpr(
        "encounter_id", f"{day('started_at')} as encounter_day"
    )
    return (
        stg_conditions.join(encounter_days, "encounter_id")
        .join(age_guard, "patient_id")
        .selectExpr(
            "patient_id",
            "encounter_id",
            "condition_code",
            f"{date_key('started_date')} as start_date_id",
            f"{date_key('stopped_date')} as stop_date_id",
            "started_date",
            "stopped_date",
            f"{days_between('started_date', 'stopped_date')} as duration_days",
            "stopped_date is null as is_open",
            f"{days_between('encounter_day', 'started_date')} as days_from_encounter_start",
            f"{completed_years('open_birth_date', 'started_date')} as patient_age_years",
        )
    )
