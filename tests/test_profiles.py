from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import by, encounter, frame

from wardstar.operators import profiling as pro
from wardstar.operators.keys import count_references
from wardstar.plans import profiles, reports


@pytest.fixture(scope="module")
def feeds(spark):
    claims = [
        dict(Id="C1", PATIENTID="P1", PROVIDERID="D1", APPOINTMENTID="E1",
             PRIMARYPATIENTINSURANCEID="0", HEALTHCARECLAIMTYPEID1="1"),
        dict(Id="C2", PATIENTID="P?", PROVIDERID="D1", APPOINTMENTID="E1",
             PRIMARYPATIENTINSURANCEID="7", HEALTHCARECLAIMTYPEID1="2"),
        dict(Id="C2", PATIENTID="P1", SUPERVISINGPROVIDERID="D?", APPOINTMENTID="E2",
             HEALTHCARECLAIMTYPEID1="1", HEALTHCARECLAIMTYPEID2="1"),
        dict(Id=None, PATIENTID="P1", APPOINTMENTID="E2", HEALTHCARECLAIMTYPEID1="1"),
        dict(Id="C4", APPOINTMENTID="E?"),
    ]
    moves = [
        dict(ID="T1", CLAIMID="C1", PATIENTID="P1", TYPE="CHARGE", AMOUNT="1.10"),
        dict(ID="T2", CLAIMID="C1", TYPE="CHARGE", AMOUNT="2.20"),
        dict(ID="T2", CLAIMID="C?", TYPE="PAYMENT", PAYMENTS="3.30"),
        dict(ID="T4", CLAIMID=None, TYPE="TRANSFEROUT", TRANSFERS="1", AMOUNT="9"),
        dict(ID="T5", CLAIMID="C2", TYPE=None),
    ]
    visits = [
        encounter("E1", "P1", "wellness", "x", "x", PAYER="Y1", TOTAL_CLAIM_COST="10.00"),
        encounter("E2", "P1", "wellness", "x", "x", PAYER="Y?", TOTAL_CLAIM_COST="20.50"),
        encounter("E3", "P1", "wellness", "x", "x", PAYER=None, TOTAL_CLAIM_COST=None),
    ]
    return {
        "claims": frame(spark, "claims", *claims),
        "transactions": frame(spark, "claims_transactions", *moves),
        "encounters": frame(spark, "encounters", *visits),
        "patients": frame(spark, "patients", {"Id": "P1"}),
        "providers": frame(spark, "providers", {"Id": "D1"}, {"Id": "D1"}),
        "payers": frame(spark, "payers", {"Id": "Y1"}),
    }


def test_profile_claims(feeds):
    rows = profiles.profile_claims(**feeds).collect()
    got = {r.figure: (r.n, r.of_n) for r in rows}
    amounts = {r.figure: str(r.amount) for r in rows if r.amount is not None}
    lost = " does not resolve"
    assert got == {
        "claims": (5, None),
        "claims with a distinct Id": (3, 5),
        "claims with a null Id": (1, 5),
        "claim transactions": (5, None),
        "claim transactions with a distinct ID": (4, 5),
        "claim transactions with a null ID": (0, 5),
        f"claims whose PATIENTID{lost}": (1, 4),
        f"claims whose PROVIDERID{lost}": (0, 2),
        f"claims whose REFERRINGPROVIDERID{lost}": (0, 0),
        f"claims whose SUPERVISINGPROVIDERID{lost}": (1, 1),
        f"claims whose APPOINTMENTID{lost} to an encounter": (1, 5),
        f"claim transactions whose PATIENTID{lost}": (0, 1),
        f"claim transactions whose PROVIDERID{lost}": (0, 0),
        f"claim transactions whose SUPERVISINGPROVIDERID{lost}": (0, 0),
        f"claim transactions whose APPOINTMENTID{lost} to an encounter": (0, 0),
        f"claim transactions whose CLAIMID{lost}": (1, 4),
        "encounters with no claim": (1, 3),
        "encounters with exactly one claim": (0, 3),
        "most claims on one encounter": (2, None),
        "encounters whose claims carry more than one HEALTHCARECLAIMTYPEID1": (1, 3),
        # A null beside a value is a mix.
        "encounters whose claims carry more than one HEALTHCARECLAIMTYPEID2": (1, 3),
        "claim transactions typed (null)": (1, 5),
        "claim transactions typed CHARGE": (2, 5),
        "claim transactions typed PAYMENT": (1, 5),
        "claim transactions typed TRANSFEROUT": (1, 5),
        "PAYMENT transactions with an AMOUNT": (0, 1),
        "PAYMENT transactions with PAYMENTS": (1, 1),
        "TRANSFEROUT transactions with an AMOUNT": (1, 1),
        "TRANSFEROUT transactions with TRANSFERS": (1, 1),
        "claims whose PRIMARYPATIENTINSURANCEID is the self-pay sentinel 0": (1, 5),
        "encounters whose PAYER is missing or does not resolve": (2, 3),
        "CHARGE transactions, AMOUNT summed": (2, None),
        "encounters, TOTAL_CLAIM_COST summed": (3, None),
    }
    assert amounts == {
        "CHARGE transactions, AMOUNT summed": "3.30",
        "encounters, TOTAL_CLAIM_COST summed": "30.50",
    }
    assert rows[0].figure == "claims" and rows[-1].figure.startswith("encounters, TOTAL")


def test_profile_of_empty_feeds(feeds):
    empty = {name: rows.limit(0) for name, rows in feeds.items()}
    got = {r.figure: (r.n, r.of_n) for r in profiles.profile_claims(**empty).collect()}
    assert got["claims with a distinct Id"] == (0, 0)
    assert got["claims whose REFERRINGPROVIDERID does not resolve"] == (0, 0)
    assert got["encounters whose PAYER is missing or does not resolve"] == (0, 0)
    assert got["most claims on one encounter"] == (None, None)


def test_profile_payer_transitions(spark, star):
    spans = frame(
        spark,
        "payer_transitions",
        {"PAYER": "Y3", "SECONDARY_PAYER": "Y4"},
        {"PAYER": "Y3", "SECONDARY_PAYER": "Y4"},
        {"PAYER": "Y3"},
        {"PAYER": "Y1", "SECONDARY_PAYER": "Y?"},
        {"PAYER": "Y?"},
        {"PAYER": None},
    )
    rows = profiles.profile_payer_transitions(spans, star.table("dim_payer")).collect()
    assert [(r.figure, r.n, r.of_n) for r in rows] == [
        ("coverage spans", 6, None),
        ("spans whose primary payer does not resolve", 2, 6),
        ("spans whose secondary payer does not resolve", 1, 6),
        ("spans with a secondary payer", 3, 6),
        (
            "spans with a secondary payer, dual_eligible primary and commercial secondary",
            2,
            3,
        ),
        (None, 1, 3),
        ("spans whose primary payer is dual eligible", 3, 6),
        ("dual eligible spans with a secondary payer", 2, 3),
    ]


def test_references_against_brute_force(spark):
    rng = random.Random(5)
    # One key holds about a third of the rows, another third is null.
    def key():
        draw = rng.random()
        return "hot" if draw < 0.33 else None if draw < 0.66 else f"k{rng.randrange(40)}"

    child = [(key(), key()) for _ in range(3000)]
    parent_a = [("hot",), ("hot",), ("k1",), ("k2",), (None,)]
    parent_b = [(f"k{i}",) for i in range(30)]
    found = count_references(
        [(spark.createDataFrame(child, "x string, y string"), {"xa": ("x", "a"), "ya": ("y", "a")}),
         (spark.createDataFrame(child, "x string, y string"), {"yb": ("y", "b")})],
        {
            "a": (spark.createDataFrame(parent_a, "k string"), "k"),
            "b": (spark.createDataFrame(parent_b, "k string"), "k"),
        },
    )
    got = {r.reference: (r.n_set, r.n_unresolved) for r in found.collect()}

    def brute(index, parent):
        known = {k for (k,) in parent}
        used = [c[index] for c in child if c[index] is not None]
        return len(used), sum(k not in known for k in used)

    assert got == {"xa": brute(0, parent_a), "ya": brute(1, parent_a), "yb": brute(1, parent_b)}


def test_children_against_brute_force(spark):
    rng = random.Random(9)
    parents = [f"p{i}" for i in range(50)]
    children = [
        (
            "p0" if rng.random() < 0.34 else rng.choice([*parents, None, "?"]),
            rng.choice(["1", "2", None]) if rng.random() < 0.05 else "1",
        )
        for _ in range(2000)
    ]
    frame_ = pro.children_per_parent(
        spark.createDataFrame([(p,) for p in parents * 2], "id string"),
        "id",
        spark.createDataFrame(children, "parent_id string, kind string"),
        "parent_id",
        ["kind"],
    )
    got = {r.parent: (r.n_children, r.kind_mixes) for r in frame_.collect()}
    counts = Counter(p for p, _ in children)
    kinds = {p: {k for q, k in children if q == p} for p in parents}
    assert got == {p: (counts[p], len(kinds[p]) > 1) for p in parents}


def test_key_profile_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert tuple(pro.key_profile(empty, "k").first()) == (0, 0, 0)


def test_reports(star):
    t = star.table
    mix = by(reports.payer_mix(t("fct_encounter"), t("dim_payer")), "payer_financial_class")
    assert (mix["medicare"].encounters, str(mix["medicare"].billed)) == (10, "1291.70")
    money = by(reports.money(t("fct_encounter"), t("stg_encounters")), "measure")
    assert str(money["uncovered"].fact_total) == "1291.60"
    assert {str(r.difference) for r in money.values()} == {"0.00"}
    across = reports.drill_across(
        t("fct_encounter"), t("fct_condition"), t("dim_date"), "calendar_year"
    )
    got = {r.calendar_year: (r.encounters, r.conditions) for r in across.collect()}
    assert got == {
        2000: (1, 1), 2001: (1, 2), 2005: (1, 0), 2010: (1, 0), 2019: (0, 1), 2020: (5, 3),
        2021: (1, 1),
    }
    shown = by(
        reports.suppression(t("dim_patient"), t("fct_encounter"), t("fct_condition")), "figure"
    )
    assert {k: r.n for k, r in shown.items()} == {
        "patients": 7, "protected patients": 3, "encounters with an age": 7,
        "encounters with the age withheld": 3, "highest age on encounters": 71,
        "conditions with an age": 7, "conditions with the age withheld": 1,
        "highest age on conditions": 71,
    }
    span = reports.residual_span(t("dim_patient"), t("fct_encounter"), t("fct_condition")).first()
    assert tuple(span) == (3, 0, 4)
    gap = by(
        reports.utilization_gap(t("fct_encounter"), t("dim_organization"), t("dim_provider")),
        "directory",
    )
    assert (gap["organization"].reported, gap["organization"].counted) == (7, 10)
    top = reports.top_conditions(t("fct_condition"), t("dim_condition"), 2).collect()
    assert [r.condition_code for r in top] == ["B", "C"]


def test_each_feed_is_read_once(spark, feeds):
    """One line of a feed's scan per feed, and one grouping of all keys."""
    found = profiles.profile_claims(**feeds)
    plan = found._jdf.queryExecution().toString()
    initial = plan[plan.index("== Physical Plan ==") :]
    initial = initial[initial.index("== Initial Plan ==") :] if "== Initial Plan ==" in initial else initial
    assert len(re.findall(r"(?:LocalTableScan|Scan ExistingRDD|FileScan)", initial)) == len(feeds)
    assert "Subquery" not in initial and "Join" not in initial
    assert initial.count("hashpartitioning(domain") == initial.count("Exchange hashpartitioning")


def test_ledger_is_sorted_by_key_before_domain(spark, feeds):
    """Keys that do not fit in memory are sorted by the first column, so it must differ."""
    plan = profiles.profile_claims(**feeds)._jdf.queryExecution().toString()
    partial = re.findall(r"HashAggregate\(keys=\[(\w+)#\d+, (\w+)#\d+\], functions=\[partial_count", plan)
    assert partial and set(partial) == {("domain_key", "domain")}
