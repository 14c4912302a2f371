from __future__ import annotations

import pytest
from conftest import CONDITIONS, ENCOUNTERS

from wardstar.operators import quality
from wardstar.plans import rule_map, rules
from wardstar.plans.rules import COLUMN_RULE, ROW_RULES, SET_RULES, TOLERATED

# What the fixture breaks on purpose.
KNOWN = {"encounter_start_not_after_patient_death": 1, "inpatient_length_of_stay_is_plausible": 1}


def rows(tables, name):
    return rules.rule_rows(name, tables).collect()


def changed(tables, name, make):
    """The lookup with one table replaced."""
    return lambda table: make(tables(name)) if table == name else tables(table)


def edit(where, **columns):
    """Change columns of the rows that meet a condition."""

    def apply(frame):
        return frame.selectExpr(
            *[
                f"cast(if({where}, {columns[c]}, {c}) as {kind}) as {c}" if c in columns else c
                for c, kind in frame.dtypes
            ]
        )

    return apply


def test_rule_counts():
    assert sum(map(len, rule_map.NOT_NULL.values())) == 133
    assert sum(map(len, rule_map.UNIQUE.values())) == 21
    assert len(rule_map.RELATIONSHIPS) == 19
    assert sum(map(len, rule_map.ACCEPTED_VALUES.values())) == 15
    assert len(ROW_RULES) + len(SET_RULES) + 1 == 19


@pytest.mark.parametrize("name", [*ROW_RULES, *SET_RULES])
def test_bespoke_rules_on_the_fixture(tables, name):
    assert len(rows(tables, name)) == KNOWN.get(name, 0)


def test_summary(spark, tables):
    summary = {r.rule: r for r in rules.rule_summary(spark, tables).collect()}
    assert len(summary) == 207
    broken = {k: (r.violations, r.status) for k, r in summary.items() if r.status != "pass"}
    assert broken == {name: (n, "warn") for name, n in KNOWN.items()}
    strict = dict.fromkeys(TOLERATED, (0, 0))
    again = {r.rule: r.status for r in rules.rule_summary(spark, tables, strict).collect()}
    assert {k for k, v in again.items() if v == "error"} == set(KNOWN)


def test_severity(spark):
    counts = spark.sql("select name, 3L as violations from values ('a'), ('b'), ('c') as t(name)")
    found = rules.with_status(counts, {"a": (0, 2), "b": (0, 3), "c": (3, 9)}).collect()
    assert {r.rule: r.status for r in found} == {"a": "error", "b": "warn", "c": "pass"}


PLANTED = [
    ("condition_grain_is_unique", "stg_conditions", lambda d: d.union(d.limit(1)), 1),
    ("condition_fact_grain_is_unique", "fct_condition", lambda d: d.union(d.limit(1)), 1),
    (
        "condition_stop_not_before_start", "stg_conditions",
        edit("condition_code = 'A'", stopped_date="date'2019-01-01'"), 1,
    ),
    (
        "encounter_stop_not_before_start", "stg_encounters",
        edit("encounter_id = 'E1'", stopped_at="timestamp_ntz'2019-01-01 00:00:00'"), 1,
    ),
    (
        "patient_death_not_before_birth", "stg_patients",
        edit("patient_id = 'P1'", death_date="date'1950-06-14'"), 1,
    ),
    (
        "encounter_payer_coverage_within_claim_cost", "stg_encounters",
        edit("encounter_id = 'E1'", payer_coverage="129.18"), 1,
    ),
    (
        "uncovered_amount_not_negative", "fct_encounter",
        edit("encounter_id = 'E1'", uncovered_amount="-0.01"), 1,
    ),
    (
        "encounter_reason_is_coded_and_labeled", "stg_encounters",
        edit("encounter_id = 'E1'", reason_code="'R'"), 1,
    ),
    (
        "length_of_stay_is_inpatient_only", "fct_encounter",
        edit("encounter_id = 'E5'", length_of_stay_days="0"), 1,
    ),
    (
        "length_of_stay_is_inpatient_only", "fct_encounter",
        edit("encounter_id = 'E5'", encounter_class="null"), 1,
    ),
    (
        "inpatient_length_of_stay_is_plausible", "fct_encounter",
        edit("encounter_id = 'E3'", stopped_at="timestamp_ntz'2021-03-01 00:00:00'"), 2,
    ),
    (
        "condition_patient_matches_encounter_patient", "fct_condition",
        edit("condition_code = 'A'", patient_id="'P4'"), 1,
    ),
    (
        "encounter_start_not_after_patient_death", "stg_patients",
        edit("patient_id = 'P4'", death_date="date'2001-02-27'"), 2,
    ),
    (
        "patient_zip3_is_a_permitted_prefix", "dim_patient",
        edit("patient_id = 'P1'", zip3="'036'"), 1,
    ),
    (
        "patient_zip3_is_a_permitted_prefix", "dim_patient",
        edit("patient_id = 'P1'", zip3="'02139'"), 1,
    ),
    (
        "safe_harbor_age_over_89_is_suppressed", "dim_patient",
        edit("patient_id = 'P3'", death_year="2008"), 1,
    ),
    (
        "safe_harbor_age_over_89_is_suppressed", "dim_patient",
        edit("patient_id = 'P3'", age_at_death_years="91"), 1,
    ),
    # P3: a year beside the death date; both facts' dates are before 90.
    (
        "safe_harbor_age_over_89_is_suppressed", "dim_patient",
        edit("patient_id = 'P3'", birth_year="1915", is_age_90_or_older="false"), 1,
    ),
    # P2: both ends of one encounter are at 90.
    (
        "safe_harbor_age_over_89_is_suppressed", "dim_patient",
        edit("patient_id = 'P2'", birth_year="1920", is_age_90_or_older="false"), 2,
    ),
    (
        "safe_harbor_age_over_89_is_suppressed", "fct_encounter",
        edit("encounter_id = 'E6'", patient_age_years="90"), 1,
    ),
    (
        "safe_harbor_age_over_89_is_suppressed", "fct_condition",
        edit("condition_code = 'E'", patient_age_years="90"), 1,
    ),
    # P2 is 85 at E10 and seen four and a half years later: 89 is guaranteed.
    (
        "fact_age_and_date_do_not_imply_over_89", "fct_encounter",
        edit("encounter_id = 'E10'", patient_age_years="85"), 0,
    ),
    (
        "fact_age_and_date_do_not_imply_over_89", "fct_encounter",
        edit("encounter_id = 'E10'", patient_age_years="86"), 1,
    ),
    (
        "fact_age_is_withheld_for_the_protected_cohort", "fct_encounter",
        edit("encounter_id = 'E10'", patient_age_years="85"), 1,
    ),
    (
        "fact_age_is_withheld_for_the_protected_cohort", "fct_condition",
        edit("condition_code = 'A'", patient_age_years="null"), 1,
    ),
]


@pytest.mark.parametrize(
    ("name", "table", "make", "expected"),
    PLANTED,
    ids=[f"{planted[0]}-{i}" for i, planted in enumerate(PLANTED)],
)
def test_planted_violation(tables, name, table, make, expected):
    assert len(rows(changed(tables, table, make), name)) == expected


@pytest.mark.parametrize("side", ["staging", "fact"])
def test_grain_rules_see_both_directions(tables, side):
    for kind, key, gone in (
        ("encounter", "encounter_id", "E1"),
        ("condition", "condition_code", "A"),
    ):
        table = f"stg_{kind}s" if side == "staging" else f"fct_{kind}"
        lacking = changed(tables, table, lambda d, k=key, g=gone: d.where(f"{k} != '{g}'"))
        found = rows(lacking, f"{kind}_fact_matches_staging_grain")
        problem = "not in staging" if side == "staging" else "missing from fact"
        assert [(r[key], r.problem) for r in found] == [(gone, problem)]


def test_grain_difference_keeps_rows_and_nulls(spark):
    from wardstar.operators import keys

    staged = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    fact = spark.createDataFrame([("a",), ("a",), ("c",), (None,), (None,)], "k string")
    found = keys.grain_difference(staged, fact, "k").collect()
    assert sorted((str(r.k), r.problem) for r in found) == [
        ("None", "missing from fact"), ("None", "not in staging"), ("None", "not in staging"),
        ("b", "missing from fact"), ("b", "missing from fact"), ("c", "not in staging"),
    ]


def test_repeated_rows_are_cut_into_chunks(spark, monkeypatch):
    from wardstar.operators import keys

    monkeypatch.setattr(keys, "REPEAT_CHUNK", 10)
    rows_ = spark.sql("select * from values ('a', 1L), ('b', 10L), ('c', 37L) as t(k, n)")
    counts = {r.k: r["count"] for r in keys.repeat_rows(rows_, "n").groupBy("k").count().collect()}
    assert counts == {"a": 1, "b": 10, "c": 37}


def test_forbidden_columns(spark, tables):
    found = rules.forbidden_columns(spark, tables("stg_patients")).collect()
    assert len(found) == 14
    assert rules.forbidden_columns(spark, tables("dim_patient")).collect() == []
    leaky = changed(tables, "dim_patient", lambda d: d.selectExpr("*", "'x' as city"))
    summary = {r.rule: r.violations for r in rules.rule_summary(spark, leaky).collect()}
    assert summary[COLUMN_RULE] == 1


GENERIC = [
    ("not_null", "fct_encounter", "payer_id", edit("encounter_id = 'E1'", payer_id="null"), 1),
    ("not_null", "dim_date", "iso_week", edit("date_id = 20200101", iso_week="null"), 1),
    ("unique", "dim_payer", "payer_name", edit("true", payer_name="'same'"), 1),
    ("unique", "dim_payer", "payer_name", edit("true", payer_name="null"), 0),
    (
        "relationships", "fct_encounter", "payer_id",
        edit("encounter_class = 'inpatient'", payer_id="'?'"), 4,
    ),
    ("relationships", "fct_encounter", "payer_id", edit("true", payer_id="null"), 0),
    (
        "relationships", "fct_condition", "stop_date_id",
        edit("condition_code = 'B'", stop_date_id="1"), 3,
    ),
    # However many rows carry it, one bad value is one failure.
    (
        "accepted_values", "stg_patients", "marital_status",
        edit("patient_id < 'P4'", marital_status="'D'"), 1,
    ),
    ("accepted_values", "stg_patients", "marital_status", edit("true", marital_status="null"), 0),
    (
        "accepted_values", "dim_date", "day_of_week",
        edit("date_id > 20210101", day_of_week="month(calendar_date)"), 4,
    ),
]


@pytest.mark.parametrize(("kind", "table", "column", "make", "expected"), GENERIC)
def test_generic_rules(spark, tables, kind, table, column, make, expected):
    found = rules.generic_failures(spark, changed(tables, table, make), kind).collect()
    got = {(r.table_name, r.column_name): r.violations for r in found}
    assert got.pop((table, column)) == expected
    assert set(got.values()) <= {0}


def test_null_checks_reach_the_scan(tables):
    frame = quality.nulls(tables("fct_encounter"), {"a": "payer_id", "b": "date_id"})
    plan = frame._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(IsNull(payer_id),IsNull(date_id))]" in plan


def test_fixture_sizes(tables):
    assert tables("fct_encounter").count() == len(ENCOUNTERS)
    assert tables("fct_condition").count() == len(CONDITIONS)
