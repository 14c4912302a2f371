"""The rules over a star with nothing withheld: no patients through the driver, same rows by any join."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import DAY

from oracle.planted import unprotected
from wardstar.plans import rules

SAFE_HARBOR = "safe_harbor_age_over_89_is_suppressed"
IMPLIED = "fact_age_and_date_do_not_imply_over_89"

# P2 is 85 at E10 and 90 at both ends of E6, P3 died at 93, P6 is 90 when the data end.
EXPECTED = {
    SAFE_HARBOR: {
        **{(p, rules.YEAR_RETAINED): 1 for p in ("P2", "P3", "P6")},
        ("P3", rules.AGE_AT_DEATH_ABOVE): 1,
        ("P2", rules.DATE_OVER_89): 2,
        ("P3", rules.DATE_OVER_89): 1,
        ("P2", rules.FACT_AGE_OVER_89["fct_encounter"]): 1,
    },
    IMPLIED: {("P2", 90, DAY(2010, 1, 12), DAY(2010, 1, 12), 90): 1},
}


@pytest.fixture
def limit(spark):
    """Sets the size up to which a side is broadcast, in the first plan and at run time."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}

    def put(size):
        for k in keys:
            spark.conf.set(k, str(size))

    yield put
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def planted(tables, name):
    return rules.rule_rows(name, unprotected(tables))


def found(tables, name):
    return Counter(tuple(r) for r in planted(tables, name).collect())


def broadcasts(rows) -> list[str]:
    """The plans of all sides that the first plan broadcasts."""

    def below(node):
        if node.getClass().getSimpleName() == "BroadcastExchangeExec":
            yield node.treeString()
        children = node.children()
        for i in range(children.size()):
            yield from below(children.apply(i))

    plan = rows._jdf.queryExecution().executedPlan()
    return [*below(plan.initialPlan())]


@pytest.mark.parametrize("size", [3_000, 10 << 20])
def test_safe_harbor_broadcasts_no_table(tables, limit, size):
    """A few columns of a compressed table look small however many patients it holds."""
    limit(size)
    for rows in (planted(tables, SAFE_HARBOR), rules.rule_rows(SAFE_HARBOR, tables)):
        assert [side for side in broadcasts(rows) if side.count("Scan") == 1] == []


@pytest.mark.parametrize("size", [10 << 20, -1])
def test_safe_harbor_by_any_join(tables, limit, size):
    limit(size)
    assert found(tables, SAFE_HARBOR) == EXPECTED[SAFE_HARBOR]


@pytest.mark.parametrize("size", [3_000, 10 << 20])
def test_implied_ages_broadcast_no_table(tables, limit, size):
    limit(size)
    for rows in (planted(tables, IMPLIED), rules.rule_rows(IMPLIED, tables)):
        assert [side for side in broadcasts(rows) if side.count("Scan") == 1] == []


@pytest.mark.parametrize("size", [10 << 20, -1])
def test_implied_ages_by_any_join(tables, limit, size):
    limit(size)
    assert found(tables, IMPLIED) == EXPECTED[IMPLIED]
