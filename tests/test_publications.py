"""A table that publishes another date is followed everywhere from one list."""

from __future__ import annotations

from conftest import DAY

from wardstar.operators import privacy
from wardstar.operators.privacy import Publication
from wardstar.plans import evidence, rules
from wardstar.sources.feeds import FEED_COLUMNS
from wardstar.sources.landing import Landing
from wardstar.plans.staging import PROFILED_COLUMNS, STAGED_COLUMNS, typed


def test_another_fact_joins_every_date_rule(spark, star, monkeypatch):
    """A prescription in 2031 makes P4, born in 1940 for this test, 91: three rules see it."""
    prescribed = spark.sql(
        "select 'R1' as prescription_id, 'P4' as patient_id, date'2031-01-01' as filled_on, 91L as patient_age_years"
    )
    births = star.table("stg_patients").selectExpr(
        *[f"if(patient_id = 'P4', date'1940-01-01', {c}) as {c}" if c == "birth_date" else c
          for c in star.table("stg_patients").columns]
    )
    dim = star.table("dim_patient").selectExpr(
        *[f"if(patient_id = 'P4', 1940L, {c}) as {c}" if c == "birth_year" else c
          for c in star.table("dim_patient").columns]
    )
    more = {"fct_prescription": prescribed, "stg_prescriptions": prescribed, "stg_patients": births, "dim_patient": dim}

    def tables(name):
        return more[name] if name in more else star.table(name)

    fourth = Publication("stg_prescriptions", ("filled_on",), "fct_prescription", "prescription", "prescription_id")
    found = (*privacy.PUBLICATIONS, fourth)
    aged = tuple(p for p in found if p.fact)
    monkeypatch.setattr(privacy, "PUBLISHED_DATES", {p.staged: p.dates for p in found})
    for module in (privacy, rules):
        monkeypatch.setattr(module, "AGED_FACTS", aged)
    dates = privacy.published_dates({n: tables(n) for n in privacy.PUBLISHED_DATES})
    assert dates.where("published_date = date'2031-01-01'").count() == 1
    seen = {r.patient_id: r.last_published_date for r in privacy.last_seen({n: tables(n) for n in privacy.PUBLISHED_DATES}).collect()}
    assert seen["P4"] == DAY(2031, 1, 1)
    harbor = rules.safe_harbor_age_over_89_is_suppressed(tables).where("patient_id = 'P4'")
    # The day and nothing else; each of its two ends is one published date.
    assert {r.violation for r in harbor.collect()} == {rules.DATE_OVER_89}
    implied = rules.fact_age_and_date_do_not_imply_over_89(tables).collect()
    assert ("P4", 91) in {(r.patient_id, r.implied_age) for r in implied}
    marks = {r.patient_id: r for r in evidence.evidence_tables(tables)["patient_marks"].collect()}
    assert marks["P4"].latest_date == DAY(2031, 1, 1) and marks["P4"].n_with_age == 4


def test_every_feed_has_a_typed_contract():
    contracts = STAGED_COLUMNS | PROFILED_COLUMNS
    assert set(contracts) == set(FEED_COLUMNS)
    for feed, columns in contracts.items():
        assert [source for source, _, _ in columns] == list(FEED_COLUMNS[feed])


def test_identifiers_never_land(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    names = [*FEED_COLUMNS["patients"], "SSN", "DRIVERS", "PASSPORT"]
    rows = spark.createDataFrame([tuple("1" if n not in ("BIRTHDATE", "DEATHDATE") else None for n in names[:-3]) + ("999-12-3456", "S99", "X99")], ", ".join(f"`{n}` string" for n in names))
    landing.put("patients", rows)
    written = "".join(p.read_text() for p in (tmp_path / "landing").rglob("*.csv") if p.is_file())
    assert "BIRTHDATE" in written and not any(s in written for s in ("999-12-3456", "S99", "X99", "SSN"))
    assert typed("patients", landing.feeds()["patients"]).count() == 1


def test_helpers_lie_apart_from_published_tables(star):
    star.build()
    assert "age_guard" in star.work.written and "age_guard" not in star.folder.written
    assert not star.work.path.startswith(star.folder.path + "/")
