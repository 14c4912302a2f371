"""The generic rules of the star, declared per table.

Fixed values: which column carries which rule. ``feed_*`` tables are the raw
feeds. Accepted values apply to non-null values only.
"""

from __future__ import annotations

NOT_NULL: dict[str, tuple[str, ...]] = {
    "feed_conditions": ("PATIENT", "ENCOUNTER"),
    "feed_encounters": ("Id",),
    "feed_organizations": ("Id",),
    "feed_patients": ("Id",),
    "feed_payers": ("Id",),
    "feed_providers": ("Id",),
    "stg_conditions": (
        "patient_id", "encounter_id", "started_date", "condition_code", "condition_description",
    ),
    "stg_encounters": (
        "encounter_id", "patient_id", "organization_id", "provider_id", "payer_id",
        "started_at", "stopped_at", "encounter_class", "encounter_code",
        "encounter_description", "base_encounter_cost", "total_claim_cost", "payer_coverage",
    ),
    "stg_organizations": ("organization_id", "organization_name", "revenue", "utilization"),
    "stg_patients": (
        "patient_id", "birth_date", "race", "ethnicity", "gender", "healthcare_expenses",
        "healthcare_coverage",
    ),
    "stg_payers": (
        "payer_id", "payer_name", "amount_covered", "amount_uncovered", "revenue",
        "covered_encounters", "uncovered_encounters", "covered_medications",
        "uncovered_medications", "covered_procedures", "uncovered_procedures",
        "covered_immunizations", "uncovered_immunizations", "unique_customers",
        "member_months", "quality_of_life_score_avg",
    ),
    "stg_providers": (
        "provider_id", "organization_id", "provider_name", "gender", "specialty", "utilization",
    ),
    "dim_condition": (
        "condition_code", "condition_description", "source_spelling_count", "condition_count",
        "patient_count",
    ),
    "dim_date": (
        "date_id", "calendar_date", "calendar_year", "calendar_quarter", "calendar_month",
        "month_name", "year_month", "day_of_month", "day_of_week", "day_name", "iso_week",
        "is_weekend",
    ),
    "dim_encounter_type": (
        "encounter_code", "encounter_description", "source_spelling_count", "encounter_count",
    ),
    "dim_organization": (
        "organization_id", "organization_name", "source_reported_utilization",
    ),
    "dim_patient": (
        "patient_id", "is_deceased", "is_age_90_or_older", "gender", "race", "ethnicity",
        "state", "lifetime_healthcare_expenses", "lifetime_healthcare_coverage",
    ),
    "dim_payer": (
        "payer_id", "payer_name", "payer_financial_class", "payer_category", "is_self_pay",
        "lifetime_amount_covered", "lifetime_amount_uncovered", "lifetime_revenue",
        "lifetime_covered_encounters", "lifetime_uncovered_encounters",
        "lifetime_unique_customers", "lifetime_member_months", "quality_of_life_score_avg",
    ),
    "dim_provider": (
        "provider_id", "organization_id", "provider_name", "gender", "specialty",
        "source_reported_utilization",
    ),
    "fct_condition": (
        "patient_id", "encounter_id", "condition_code", "start_date_id", "started_date",
        "is_open", "days_from_encounter_start",
    ),
    "fct_encounter": (
        "encounter_id", "date_id", "patient_id", "organization_id", "provider_id", "payer_id",
        "encounter_code", "encounter_class", "started_at", "stopped_at", "duration_minutes",
        "condition_count", "base_encounter_cost", "total_claim_cost", "payer_coverage",
        "uncovered_amount",
    ),
}

UNIQUE: dict[str, tuple[str, ...]] = {
    "feed_encounters": ("Id",),
    "feed_organizations": ("Id",),
    "feed_patients": ("Id",),
    "feed_payers": ("Id",),
    "feed_providers": ("Id",),
    "stg_encounters": ("encounter_id",),
    "stg_organizations": ("organization_id",),
    "stg_patients": ("patient_id",),
    "stg_payers": ("payer_id", "payer_name"),
    "stg_providers": ("provider_id",),
    "dim_condition": ("condition_code",),
    "dim_date": ("date_id", "calendar_date"),
    "dim_encounter_type": ("encounter_code",),
    "dim_organization": ("organization_id",),
    "dim_patient": ("patient_id",),
    "dim_payer": ("payer_id", "payer_name"),
    "dim_provider": ("provider_id",),
    "fct_encounter": ("encounter_id",),
}

# Child table, its key, parent table, its key.
RELATIONSHIPS: tuple[tuple[str, str, str, str], ...] = (
    ("stg_conditions", "patient_id", "stg_patients", "patient_id"),
    ("stg_conditions", "encounter_id", "stg_encounters", "encounter_id"),
    ("stg_encounters", "patient_id", "stg_patients", "patient_id"),
    ("stg_encounters", "organization_id", "stg_organizations", "organization_id"),
    ("stg_encounters", "provider_id", "stg_providers", "provider_id"),
    ("stg_encounters", "payer_id", "stg_payers", "payer_id"),
    ("stg_providers", "organization_id", "stg_organizations", "organization_id"),
    ("dim_provider", "organization_id", "dim_organization", "organization_id"),
    ("fct_condition", "patient_id", "dim_patient", "patient_id"),
    ("fct_condition", "encounter_id", "fct_encounter", "encounter_id"),
    ("fct_condition", "condition_code", "dim_condition", "condition_code"),
    ("fct_condition", "start_date_id", "dim_date", "date_id"),
    ("fct_condition", "stop_date_id", "dim_date", "date_id"),
    ("fct_encounter", "date_id", "dim_date", "date_id"),
    ("fct_encounter", "patient_id", "dim_patient", "patient_id"),
    ("fct_encounter", "organization_id", "dim_organization", "organization_id"),
    ("fct_encounter", "provider_id", "dim_provider", "provider_id"),
    ("fct_encounter", "payer_id", "dim_payer", "payer_id"),
    ("fct_encounter", "encounter_code", "dim_encounter_type", "encounter_code"),
)

_CLASSES = ("ambulatory", "emergency", "inpatient", "outpatient", "urgentcare", "wellness")
_GENDERS = ("M", "F")

ACCEPTED_VALUES: dict[str, dict[str, tuple]] = {
    "stg_encounters": {"encounter_class": _CLASSES},
    "stg_organizations": {"state": ("MA",)},
    "stg_patients": {
        "marital_status": ("M", "S"),
        "race": ("white", "black", "asian", "hawaiian", "native", "other"),
        "ethnicity": ("hispanic", "nonhispanic"),
        "gender": _GENDERS,
    },
    "stg_providers": {"gender": _GENDERS, "state": ("MA",)},
    "dim_date": {"calendar_quarter": (1, 2, 3, 4), "day_of_week": (1, 2, 3, 4, 5, 6, 7)},
    "dim_patient": {"gender": _GENDERS},
    "dim_payer": {
        "payer_financial_class": (
            "medicare", "medicaid", "dual_eligible", "commercial", "self_pay",
        ),
        "payer_category": ("self_pay", "public", "commercial"),
    },
    "dim_provider": {"gender": _GENDERS},
    "fct_encounter": {"encounter_class": _CLASSES},
}
