"""The seven conformed dimensions, each a function of staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.fixed import PROTECTED_AGE
from wardstar.functions.scalars import (
    collapse_whitespace,
    completed_years,
    is_protected_age,
    payer_class,
    payer_rollup,
    trailing_tag,
    unless_protected,
    zip_prefix,
)
from wardstar.operators.calendar import calendar, daily_series
from wardstar.operators.labels import canonical_label, label_and_members
from wardstar.operators.privacy import attained_age


def dim_condition(stg_conditions: DataFrame) -> DataFrame:
    """One row per condition code."""
    labels = label_and_members(
        stg_conditions,
        "condition_code",
        "condition_description",
        "patient_id",
        spellings_as="source_spelling_count",
        rows_as="condition_count",
        members_as="patient_count",
    )
    return labels.selectExpr(
        "condition_code",
        "condition_description",
        f"{trailing_tag('condition_description')} as source_semantic_tag",
        "source_spelling_count",
        "condition_count",
        "patient_count",
    )


def dim_encounter_type(stg_encounters: DataFrame) -> DataFrame:
    """One row per encounter code; the class stays on the fact."""
    return canonical_label(
        stg_encounters,
        "encounter_code",
        "encounter_description",
        spellings_as="source_spelling_count",
        rows_as="encounter_count",
    )


def dim_date(stg_encounters: DataFrame) -> DataFrame:
    """One row per day from the first to the last encounter start."""
    return calendar(daily_series(stg_encounters, "started_at"))


def dim_organization(stg_organizations: DataFrame) -> DataFrame:
    return stg_organizations.selectExpr(
        "organization_id",
        f"{collapse_whitespace('organization_name')} as organization_name",
        "street_address",
        "city",
        "state",
        "zip_code",
        "latitude",
        "longitude",
        "phone",
        "utilization as source_reported_utilization",
    )


def dim_provider(stg_providers: DataFrame) -> DataFrame:
    """Clinicians; their address is their organization's and stays there."""
    return stg_providers.selectExpr(
        "provider_id",
        "organization_id",
        "provider_name",
        "gender",
        "specialty",
        "utilization as source_reported_utilization",
    )


def dim_payer(stg_payers: DataFrame) -> DataFrame:
    """Payers with a financial class, and the category derived from that class."""
    lifetime = (
        "amount_covered",
        "amount_uncovered",
        "revenue",
        "covered_encounters",
        "uncovered_encounters",
        "unique_customers",
        "member_months",
    )
    return stg_payers.selectExpr(
        "*", f"{payer_class('payer_name')} as payer_financial_class"
    ).selectExpr(
        "payer_id",
        "payer_name",
        "payer_financial_class",
        f"{payer_rollup('payer_financial_class')} as payer_category",
        "payer_financial_class = 'self_pay' as is_self_pay",
        "headquarters_state",
        *[f"{name} as lifetime_{name}" for name in lifetime],
        "quality_of_life_score_avg",
    )


def dim_patient(stg_patients: DataFrame, patient_last_seen: DataFrame) -> DataFrame:
    """Patients without names, full dates or fine geography.

    A patient any published date puts over 89 loses both years and joins one
    category; the age at death is capped at that category.
    """
    age = "max_attained_age"
    at_death = completed_years("birth_date", "death_date")
    return (
        attained_age(stg_patients, patient_last_seen)
        .selectExpr("*", f"{at_death} as exact_age_at_death")
        .selectExpr(
            "patient_id",
            f"cast({unless_protected(age, 'year(birth_date)')} as bigint) as birth_year",
            f"cast({unless_protected(age, 'year(death_date)')} as bigint) as death_year",
            "death_date is not null as is_deceased",
            f"{is_protected_age(age)} as is_age_90_or_older",
            f"""if(exact_age_at_death is null, null, least(exact_age_at_death, {PROTECTED_AGE}))
              as age_at_death_years""",
            "gender",
            "race",
            "ethnicity",
            "marital_status",
            "state",
            f"{zip_prefix('zip_code')} as zip3",
            "healthcare_expenses as lifetime_healthcare_expenses",
            "healthcare_coverage as lifetime_healthcare_coverage",
        )
    )
