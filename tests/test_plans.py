"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

from wardstar.plans import rules
from wardstar.plans.star import MODELS


def physical(frame) -> str:
    text = frame._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :]


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every side were too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", list(MODELS))
def test_no_broadcast_is_forced(no_broadcast, star, name):
    plan = physical(star.lazy(name))
    for operator in ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert operator not in plan
    assert "Python" not in plan and "Window" not in plan


@pytest.mark.parametrize("name", list(rules.SET_RULES))
def test_rules_force_no_broadcast(no_broadcast, tables, name):
    plan = physical(rules.rule_rows(name, tables))
    for operator in ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert operator not in plan


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)


def test_encounters_move_twice(no_broadcast, star):
    keys = exchanges(physical(star.lazy("fct_encounter")))
    # Encounters and counted conditions by encounter, then the rows and patients.
    assert sorted(k.split("#")[0] for k in keys) == [
        "encounter_id", "encounter_id", "patient_id", "patient_id",
    ]


def test_grain_difference_moves_each_side_once(no_broadcast, tables):
    plan = physical(rules.rule_rows("condition_fact_matches_staging_grain", tables))
    initial = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
    assert "SortMergeJoin" not in initial
    # One grouping, and the dealing out of what it found.
    assert len(exchanges(initial)) == 2


def test_relationships_need_no_join(no_broadcast, spark, tables):
    plan = physical(rules.generic_failures(spark, tables, "relationships"))
    assert "Join" not in plan


def test_only_needed_columns_are_read(tables):
    frame = rules.rule_rows("uncovered_amount_not_negative", tables)
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "started_at" not in schema
    assert "LessThan(uncovered_amount" in plan
