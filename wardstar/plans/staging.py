"""Typed staging tables: rename and cast, same grain as the feed.

Casts are strict: text that does not parse is an error, an empty field is null.
Social security, driving licence and passport numbers are not listed, so the
scan never reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TEXT = "string"
DAY = "date"
MOMENT = "timestamp_ntz"
MONEY = "decimal(18,2)"
REAL = "double"
COUNT = "int"

#: By feed: source column, name, type.
Contracts = dict[str, tuple[tuple[str, str, str], ...]]

# Feed column, staged column, type.
STAGED_COLUMNS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "patients": (
        ("Id", "patient_id", TEXT),
        ("BIRTHDATE", "birth_date", DAY),
        ("DEATHDATE", "death_date", DAY),
        ("PREFIX", "name_prefix", TEXT),
        ("FIRST", "first_name", TEXT),
        ("LAST", "last_name", TEXT),
        ("SUFFIX", "name_suffix", TEXT),
        ("MAIDEN", "maiden_name", TEXT),
        ("MARITAL", "marital_status", TEXT),
        ("RACE", "race", TEXT),
        ("ETHNICITY", "ethnicity", TEXT),
        ("GENDER", "gender", TEXT),
        ("BIRTHPLACE", "birthplace", TEXT),
        ("ADDRESS", "street_address", TEXT),
        ("CITY", "city", TEXT),
        ("STATE", "state", TEXT),
        ("COUNTY", "county", TEXT),
        ("ZIP", "zip_code", TEXT),
        ("LAT", "latitude", REAL),
        ("LON", "longitude", REAL),
        ("HEALTHCARE_EXPENSES", "healthcare_expenses", MONEY),
        ("HEALTHCARE_COVERAGE", "healthcare_coverage", MONEY),
    ),
    "encounters": (
        ("Id", "encounter_id", TEXT),
        ("PATIENT", "patient_id", TEXT),
        ("ORGANIZATION", "organization_id", TEXT),
        ("PROVIDER", "provider_id", TEXT),
        ("PAYER", "payer_id", TEXT),
        ("START", "started_at", MOMENT),
        ("STOP", "stopped_at", MOMENT),
        ("ENCOUNTERCLASS", "encounter_class", TEXT),
        ("CODE", "encounter_code", TEXT),
        ("DESCRIPTION", "encounter_description", TEXT),
        ("REASONCODE", "reason_code", TEXT),
        ("REASONDESCRIPTION", "reason_description", TEXT),
        ("BASE_ENCOUNTER_COST", "base_encounter_cost", MONEY),
        ("TOTAL_CLAIM_COST", "total_claim_cost", MONEY),
        ("PAYER_COVERAGE", "payer_coverage", MONEY),
    ),
    "conditions": (
        ("PATIENT", "patient_id", TEXT),
        ("ENCOUNTER", "encounter_id", TEXT),
        ("START", "started_date", DAY),
        ("STOP", "stopped_date", DAY),
        ("CODE", "condition_code", TEXT),
        ("DESCRIPTION", "condition_description", TEXT),
    ),
    "organizations": (
        ("Id", "organization_id", TEXT),
        ("NAME", "organization_name", TEXT),
        ("ADDRESS", "street_address", TEXT),
        ("CITY", "city", TEXT),
        ("STATE", "state", TEXT),
        ("ZIP", "zip_code", TEXT),
        ("LAT", "latitude", REAL),
        ("LON", "longitude", REAL),
        ("PHONE", "phone", TEXT),
        ("REVENUE", "revenue", MONEY),
        ("UTILIZATION", "utilization", COUNT),
    ),
    "providers": (
        ("Id", "provider_id", TEXT),
        ("ORGANIZATION", "organization_id", TEXT),
        ("NAME", "provider_name", TEXT),
        ("GENDER", "gender", TEXT),
        ("SPECIALITY", "specialty", TEXT),
        ("ADDRESS", "street_address", TEXT),
        ("CITY", "city", TEXT),
        ("STATE", "state", TEXT),
        ("ZIP", "zip_code", TEXT),
        ("LAT", "latitude", REAL),
        ("LON", "longitude", REAL),
        ("UTILIZATION", "utilization", COUNT),
    ),
    "payers": (
        ("Id", "payer_id", TEXT),
        ("NAME", "payer_name", TEXT),
        ("ADDRESS", "street_address", TEXT),
        ("CITY", "city", TEXT),
        ("STATE_HEADQUARTERED", "headquarters_state", TEXT),
        ("ZIP", "zip_code", TEXT),
        ("PHONE", "phone", TEXT),
        ("AMOUNT_COVERED", "amount_covered", MONEY),
        ("AMOUNT_UNCOVERED", "amount_uncovered", MONEY),
        ("REVENUE", "revenue", MONEY),
        ("COVERED_ENCOUNTERS", "covered_encounters", COUNT),
        ("UNCOVERED_ENCOUNTERS", "uncovered_encounters", COUNT),
        ("COVERED_MEDICATIONS", "covered_medications", COUNT),
        ("UNCOVERED_MEDICATIONS", "uncovered_medications", COUNT),
        ("COVERED_PROCEDURES", "covered_procedures", COUNT),
        ("UNCOVERED_PROCEDURES", "uncovered_procedures", COUNT),
        ("COVERED_IMMUNIZATIONS", "covered_immunizations", COUNT),
        ("UNCOVERED_IMMUNIZATIONS", "uncovered_immunizations", COUNT),
        ("UNIQUE_CUSTOMERS", "unique_customers", COUNT),
        ("MEMBER_MONTHS", "member_months", COUNT),
        ("QOLS_AVG", "quality_of_life_score_avg", REAL),
    ),
}

# The feeds no table is built from, read by profiles as they are.
PROFILED_COLUMNS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "claims": (
        ("Id", "claim_id", TEXT),
        ("PATIENTID", "patient_id", TEXT),
        ("PROVIDERID", "provider_id", TEXT),
        ("REFERRINGPROVIDERID", "referring_provider_id", TEXT),
        ("SUPERVISINGPROVIDERID", "supervising_provider_id", TEXT),
        ("APPOINTMENTID", "encounter_id", TEXT),
        ("PRIMARYPATIENTINSURANCEID", "primary_insurance_id", TEXT),
        ("HEALTHCARECLAIMTYPEID1", "claim_type_1", TEXT),
        ("HEALTHCARECLAIMTYPEID2", "claim_type_2", TEXT),
    ),
    "claims_transactions": (
        ("ID", "transaction_id", TEXT),
        ("CLAIMID", "claim_id", TEXT),
        ("PATIENTID", "patient_id", TEXT),
        ("PROVIDERID", "provider_id", TEXT),
        ("SUPERVISINGPROVIDERID", "supervising_provider_id", TEXT),
        ("APPOINTMENTID", "encounter_id", TEXT),
        ("TYPE", "transaction_type", TEXT),
        ("AMOUNT", "amount", MONEY),
        ("PAYMENTS", "payments", MONEY),
        ("TRANSFERS", "transfers", MONEY),
    ),
    "payer_transitions": (
        ("PAYER", "payer_id", TEXT),
        ("SECONDARY_PAYER", "secondary_payer_id", TEXT),
    ),
}


def typed(feed: str, rows: DataFrame) -> DataFrame:
    """Any of the nine feeds under its typed contract."""
    return stage(feed, rows, STAGED_COLUMNS | PROFILED_COLUMNS)


def stage(feed: str, rows: DataFrame, contracts: Contracts = STAGED_COLUMNS) -> DataFrame:
    """The typed staging table of one raw feed."""
    if rows.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled: without it bad text becomes null")
    return rows.selectExpr(
        *[f"cast(`{source}` as {kind}) as {name}" for source, name, kind in contracts[feed]]
    )
