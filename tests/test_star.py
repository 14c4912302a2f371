from __future__ import annotations

import decimal
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import CONDITIONS, DAY, ENCOUNTERS, by, clinical_feeds, frame, patient

from wardstar.operators.calendar import calendar
from wardstar.operators.labels import canonical_label
from wardstar.operators.privacy import last_seen, published_dates
from wardstar.plans import dimensions, reports
from wardstar.plans.staging import stage
from wardstar.plans.star import MODELS, Star, files_digest
from wardstar.sources.feeds import csv_feeds, write_feed


def test_fifteen_tables():
    assert len(MODELS) == 15


def test_patients(star):
    rows = by(star.table("dim_patient"), "patient_id")
    protected = {k for k, r in rows.items() if r.is_age_90_or_older}
    assert protected == {"P2", "P3", "P6"}
    assert (rows["P1"].birth_year, rows["P1"].zip3, rows["P1"].is_deceased) == (1950, "021", False)
    assert (rows["P2"].birth_year, rows["P2"].death_year) == (None, None)
    assert rows["P2"].age_at_death_years == 88
    assert (rows["P3"].age_at_death_years, rows["P3"].zip3) == (90, None)
    assert rows["P4"].zip3 == "000"
    assert rows["P5"].birth_year == 1931
    assert (rows["P7"].age_at_death_years, rows["P7"].birth_year, rows["P7"].death_year) == (
        89, 1920, 2010,
    )


def test_encounters(star):
    rows = by(star.table("fct_encounter"), "encounter_id")
    got = {
        k: (r.duration_minutes, r.length_of_stay_days, r.patient_age_years, r.condition_count)
        for k, r in rows.items()
    }
    assert got == {
        "E1": (20, 1, 69, 2),
        "E2": (720, 0, 69, 1),
        "E3": (527040, 366, 69, 0),
        "E4": (528480, 367, 69, 0),
        "E5": (0, None, 70, 1),
        "E6": (30, None, None, 0),
        "E7": (15, None, 0, 2),
        "E8": (60, None, None, 1),
        "E9": (20, None, 71, 1),
        "E10": (30, None, None, 0),
    }
    assert rows["E1"].date_id == 20200101
    assert rows["E1"].total_claim_cost == decimal.Decimal("129.17")
    assert rows["E1"].uncovered_amount == decimal.Decimal("129.16")


def test_conditions(star):
    rows = by(star.table("fct_condition"), "patient_id", "encounter_id", "condition_code")
    a, b = rows["P1", "E1", "A"], rows["P1", "E1", "B"]
    assert (a.is_open, a.duration_days, a.days_from_encounter_start) == (True, None, 1)
    assert (a.start_date_id, a.stop_date_id) == (20200102, None)
    assert (b.duration_days, b.days_from_encounter_start, b.patient_age_years) == (10, -1, 69)
    assert rows["P3", "E8", "E"].patient_age_years is None


def test_condition_labels(star):
    rows = by(star.table("dim_condition"), "condition_code")
    got = {k: tuple(r)[1:] for k, r in rows.items()}
    assert got == {
        "A": ("Full-time employment (finding)", "finding", 1, 1, 1),
        "B": ("Pneumonia (disorder)", "disorder", 2, 3, 2),
        "C": ("Epilepsy", None, 2, 2, 2),
        "D": ("Severe anxiety (panic) (finding", None, 1, 1, 1),
        "E": ("Stress (finding)\n", None, 1, 1, 1),
    }


def test_labels_put_null_last_and_ignore_row_order(spark):
    pairs = [("x", None), ("x", "b"), ("x", "a"), ("y", None), (None, "n")]
    for order in (pairs, pairs[::-1]):
        rows = spark.createDataFrame(order, "code string, label string")
        labels = canonical_label(rows, "code", "label", spellings_as="s", rows_as="n")
        got = {r.code: (r.label, r.s, r.n) for r in labels.collect()}
        assert got == {"x": ("a", 3, 3), "y": (None, 1, 1), None: ("n", 1, 1)}


def test_calendar(star, spark):
    days = by(star.table("dim_date"), "date_id")
    assert min(days) == 20000101 and max(days) == 20211119
    assert len(days) == (DAY(2021, 11, 19) - DAY(2000, 1, 1)).days + 1
    for r in days.values():
        iso = r.calendar_date.isocalendar()
        assert (r.iso_year, r.iso_week, r.day_of_week) == tuple(iso)
        assert r.iso_year_week == iso.year * 100 + iso.week
        assert r.is_weekend == (iso.weekday >= 6)
        assert r.day_name == r.calendar_date.strftime("%A")
        assert r.month_name == r.calendar_date.strftime("%B")
        assert r.year_month == r.calendar_date.strftime("%Y-%m")
    edge = spark.sql("select explode(array(date'2019-12-30', date'2020-01-01')) as calendar_date")
    assert {r.iso_year_week for r in calendar(edge).collect()} == {202001}
    assert (days[20210103].iso_year_week, days[20210103].is_weekend) == (202053, True)


def test_payers_and_organizations(star):
    rows = by(star.table("dim_payer"), "payer_name")
    got = {
        k: (r.payer_financial_class, r.payer_category, r.is_self_pay) for k, r in rows.items()
    }
    assert got == {
        "NO_INSURANCE": ("self_pay", "self_pay", True),
        "Medicare": ("medicare", "public", False),
        "Medicaid": ("medicaid", "public", False),
        "Dual Eligible": ("dual_eligible", "public", False),
        "Blue Shield": ("commercial", "commercial", False),
    }
    assert star.table("dim_organization").first().organization_name == "St. Mary Hospital"
    assert "street_address" not in star.table("dim_provider").columns


def test_types(star):
    assert dict(star.table("stg_encounters").dtypes)["started_at"] == "timestamp_ntz"
    kinds = dict(star.table("fct_encounter").dtypes)
    assert (kinds["date_id"], kinds["uncovered_amount"]) == ("int", "decimal(19,2)")
    assert kinds["patient_age_years"] == kinds["duration_minutes"] == "bigint"


def test_last_seen_is_the_latest_published_date(star):
    inputs = {n: star.table(n) for n in ("stg_patients", "stg_encounters", "stg_conditions")}
    seen = {r.patient_id: r.last_published_date for r in last_seen(inputs).collect()}
    latest: dict = {}
    for r in published_dates(inputs).collect():
        latest[r.patient_id] = max(latest.get(r.patient_id, r.published_date), r.published_date)
    assert {k: v for k, v in seen.items() if v is not None} == latest
    assert seen["P1"] == DAY(2021, 11, 19)


def test_without_any_date_years_are_withheld(spark):
    patients = stage("patients", frame(spark, "patients", patient("P", "1990-01-01")))
    seen = spark.createDataFrame([], "patient_id string, last_published_date date")
    row = dimensions.dim_patient(patients, seen).first()
    assert (row.birth_year, row.death_year, row.is_age_90_or_older) == (None, None, None)


def test_patients_without_birth_date(spark):
    patients = stage("patients", frame(spark, "patients", patient("P", None, "2001-01-01")))
    seen = spark.sql("select 'P' as patient_id, date'2001-01-01' as last_published_date")
    row = dimensions.dim_patient(patients, seen).first()
    assert (row.death_year, row.is_age_90_or_older, row.age_at_death_years) == (None, None, None)


@pytest.mark.parametrize("name", ["dim_condition", "dim_encounter_type", "fct_condition"])
def test_row_order_changes_nothing(spark, star, name):
    feeds = clinical_feeds(spark)
    feeds["encounters"] = frame(spark, "encounters", *ENCOUNTERS[::-1])
    feeds["conditions"] = frame(spark, "conditions", *CONDITIONS[::-1])
    again = Star(spark, feeds, tempfile.mkdtemp(prefix="wardstar-tests-"))
    expected = sorted(map(str, star.table(name).collect()))
    assert sorted(map(str, again.lazy(name).collect())) == expected


def test_star_from_csv_files(spark, star, tmp_path):
    for feed, rows in star.feeds.items():
        write_feed(rows, f"{tmp_path}/in/{feed}.csv")
    again = Star(spark, csv_feeds(spark, f"{tmp_path}/in"), f"{tmp_path}/out")
    for name, rows in again.build().items():
        assert rows.schema == star.table(name).schema
        assert sorted(map(str, rows.collect())) == sorted(map(str, star.table(name).collect()))


def test_tables_are_written_once(star):
    assert star.table("dim_patient") is star.table("dim_patient")


def test_four_threads_write_a_table_once(spark, tmp_path):
    star = Star(spark, clinical_feeds(spark), str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(star.table, ["stg_conditions"] * 4))
    assert len({id(f) for f in found}) == 1
    assert found[0].count() == len(list(star.feeds["conditions"].collect()))


def test_changed_input_gives_another_star(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    before = files_digest(spark, str(tmp_path))
    spark.range(4).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert files_digest(spark, str(tmp_path)) != before


def test_drill_across_keeps_every_fact(spark):
    encounters = spark.createDataFrame([("E1", 20200101), ("E2", None)], "encounter_id string, date_id int")
    conditions = spark.createDataFrame([("C1", 20200101), ("C2", 19990101)], "k string, start_date_id int")
    days = spark.createDataFrame([(20200101, "2020-01")], "date_id int, year_month string")
    got = reports.drill_across(encounters, conditions, days, "year_month").collect()
    assert {tuple(r) for r in got} == {("2020-01", 1, 1), (None, 1, 1)}
