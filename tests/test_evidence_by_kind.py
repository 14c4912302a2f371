"""The rules of one kind are answered without the evidence of the others."""

from __future__ import annotations

import pytest
from conftest import clinical_feeds

from wardstar.plans import rules
from wardstar.plans.star import Star


@pytest.fixture
def fresh(spark, tmp_path):
    return Star(spark, clinical_feeds(spark), str(tmp_path / "star"))


def test_accepted_values_write_no_ledger(spark, star, fresh):
    kind = "accepted_values"
    found = rules.generic_failures(spark, fresh.table, kind, fresh.evidence(kind)).collect()
    assert sorted(found) == sorted(rules.generic_failures(spark, star.table, kind).collect())
    unasked = {"key_ledger", "patient_marks", "suspect_periods", "fct_condition"}
    assert not unasked & set(fresh._written)


@pytest.mark.parametrize("kind", ["unique", "relationships"])
def test_keys_of_one_kind_are_counted_alone(spark, star, fresh, kind):
    part = fresh.evidence(kind)
    found = rules.generic_failures(spark, fresh.table, kind, part).collect()
    assert sorted(found) == sorted(rules.generic_failures(spark, star.table, kind).collect())
    assert not {"key_ledger", "patient_marks", "suspect_periods"} & set(fresh._written)
    assert all(use.domain != "condition grain" for use in part.uses.values())


def test_tables_are_observed_for_rules_only(spark, star, fresh):
    fresh.table("fct_encounter")
    assert not fresh.figures
    found = rules.rule_summary(spark, fresh.table, evidence=fresh.evidence()).collect()
    assert sorted(found) == sorted(rules.rule_summary(spark, star.table).collect())
