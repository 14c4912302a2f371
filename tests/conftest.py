from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import SparkSession

from wardstar.plans.star import Star
from wardstar.sources.feeds import FEED_COLUMNS


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        # Not UTC on purpose: no result may depend on the session zone.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wardstar-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def feed_rows(feed: str, *rows: dict) -> list[tuple]:
    return [tuple(row.get(c) for c in FEED_COLUMNS[feed]) for row in rows]


def frame(spark, feed: str, *rows: dict):
    schema = ", ".join(f"`{c}` string" for c in FEED_COLUMNS[feed])
    return spark.createDataFrame(feed_rows(feed, *rows), schema)


def patient(key, birth, death=None, zip_code=None, **extra):
    return {
        "Id": key, "BIRTHDATE": birth, "DEATHDATE": death, "ZIP": zip_code, "GENDER": "F",
        "RACE": "white", "ETHNICITY": "hispanic", "STATE": "MA", "MARITAL": "M",
        "FIRST": "Ann", "LAST": "Doe", "LAT": "42.1", "LON": "-71.2",
        "HEALTHCARE_EXPENSES": "10.00", "HEALTHCARE_COVERAGE": "4.00", **extra,
    }


def encounter(key, person, kind, start, stop, **extra):
    return {
        "Id": key, "PATIENT": person, "ORGANIZATION": "O1", "PROVIDER": "D1", "PAYER": "Y1",
        "START": start, "STOP": stop, "ENCOUNTERCLASS": kind, "CODE": "100",
        "DESCRIPTION": "Visit", "BASE_ENCOUNTER_COST": "129.16", "TOTAL_CLAIM_COST": "129.165",
        "PAYER_COVERAGE": "0.005", **extra,
    }


def condition(person, visit, code, start, stop, label):
    return {
        "PATIENT": person, "ENCOUNTER": visit, "CODE": code, "START": start, "STOP": stop,
        "DESCRIPTION": label,
    }


PATIENTS = [
    patient("P1", "1950-06-15", None, "02139"),
    patient("P2", "1920-01-10", "2009-01-09", "01002"),
    patient("P3", "1915-03-01", "2008-03-01"),
    patient("P4", "2000-02-29", None, "03601"),
    patient("P5", "1931-11-20", None, "01002"),
    patient("P6", "1931-11-19", None, "01002"),
    patient("P7", "1920-12-31", "2010-01-01", "01002"),
]
ENCOUNTERS = [
    encounter("E1", "P1", "inpatient", "2020-01-01T23:50:00Z", "2020-01-02T00:10:30Z"),
    encounter("E2", "P1", "inpatient", "2020-03-01T08:00:00Z", "2020-03-01T20:00:00Z"),
    encounter("E3", "P1", "inpatient", "2020-02-28T00:00:00Z", "2021-02-28T00:00:00Z"),
    encounter("E4", "P1", "inpatient", "2020-02-28T00:00:00Z", "2021-03-01T00:00:00Z"),
    encounter("E5", "P1", "ambulatory", "2020-06-15T10:00:50Z", "2020-06-15T10:01:10Z"),
    encounter("E6", "P2", "wellness", "2010-01-12T09:00:00Z", "2010-01-12T09:30:00Z"),
    encounter("E7", "P4", "wellness", "2001-02-28T09:00:00Z", "2001-02-28T09:15:00Z"),
    encounter("E8", "P3", "emergency", "2000-01-01T00:00:00Z", "2000-01-01T01:00:00Z"),
    encounter("E9", "P1", "outpatient", "2021-11-19T12:00:00Z", "2021-11-19T12:20:00Z"),
    encounter("E10", "P2", "wellness", "2005-05-05T09:00:00Z", "2005-05-05T09:30:00Z"),
]
CONDITIONS = [
    condition("P1", "E1", "A", "2020-01-02", None, "Full-time employment (finding)"),
    condition("P1", "E1", "B", "2019-12-31", "2020-01-10", "Pneumonia (disorder)"),
    condition("P1", "E2", "B", "2020-03-01", "2020-03-05", "Pneumonia (disorder)"),
    condition("P4", "E7", "B", "2001-02-28", "2001-03-03", "Pneumonia"),
    condition("P1", "E5", "C", "2020-06-15", None, "Epilepsy (disorder)"),
    condition("P4", "E7", "C", "2001-02-28", None, "Epilepsy"),
    condition("P1", "E9", "D", "2021-11-19", None, "Severe anxiety (panic) (finding"),
    condition("P3", "E8", "E", "2000-01-01", None, "Stress (finding)\n"),
]
PAYER_NAMES = ["NO_INSURANCE", "Medicare", "Medicaid", "Dual Eligible", "Blue Shield"]


def clinical_feeds(spark) -> dict:
    counts = {
        c: "1"
        for c in FEED_COLUMNS["payers"]
        if c.startswith(("COVERED", "UNCOVERED", "UNIQUE", "MEMBER"))
    }
    money = {"AMOUNT_COVERED": "1.10", "AMOUNT_UNCOVERED": "2.20", "REVENUE": "3.30"}
    payers = [
        {"Id": f"Y{i}", "NAME": name, "QOLS_AVG": "0.9", **counts, **money}
        for i, name in enumerate(PAYER_NAMES)
    ]
    organization = {
        "Id": "O1", "NAME": " St.  Mary\t Hospital ", "STATE": "MA", "ZIP": "01002",
        "LAT": "42.0", "LON": "-71.0", "REVENUE": "5.00", "UTILIZATION": "7",
    }
    provider = {
        "Id": "D1", "ORGANIZATION": "O1", "NAME": "Dr. Who", "GENDER": "M",
        "SPECIALITY": "GENERAL PRACTICE", "STATE": "MA", "LAT": "42.0", "LON": "-71.0",
        "UTILIZATION": "3",
    }
    return {
        "patients": frame(spark, "patients", *PATIENTS),
        "encounters": frame(spark, "encounters", *ENCOUNTERS),
        "conditions": frame(spark, "conditions", *CONDITIONS),
        "payers": frame(spark, "payers", *payers),
        "organizations": frame(spark, "organizations", organization),
        "providers": frame(spark, "providers", provider),
    }


@pytest.fixture(scope="session")
def star(spark):
    built = Star(spark, clinical_feeds(spark), tempfile.mkdtemp(prefix="wardstar-tests-"))
    built.build()
    return built


@pytest.fixture(scope="session")
def tables(star):
    return star.table


def by(rows, *keys):
    """Collected rows keyed by one column or several."""
    found = {}
    for row in rows.collect():
        key = tuple(row[k] for k in keys)
        found[key[0] if len(key) == 1 else key] = row
    return found


DAY = dt.date
