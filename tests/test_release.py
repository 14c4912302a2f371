"""Rules answered from what a build leaves, the gate, and published versions."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import clinical_feeds
from test_plans import physical

import __spark_entry__ as registry
from wardstar.operators.ledger import KeyFigure, Use, key_figures, key_ledger
from wardstar.plans import evidence, rules
from wardstar.plans.star import EVIDENCE, MODELS, PublishedStar, Star, star_over_orders
from wardstar.sources.files import SharedFiles
from wardstar.sources.tables import TableFolder

STRICT = dict.fromkeys(rules.TOLERATED, (0, 0))


@pytest.fixture
def built(spark, tmp_path):
    return Star(spark, clinical_feeds(spark), str(tmp_path / "star"))


def summary(spark, tables, found=None):
    rows = rules.rule_summary(spark, tables, rules.TOLERATED, found).collect()
    return {r.rule: (r.violations, r.status) for r in rows}


def test_evidence_gives_the_same_summary(spark, star):
    assert summary(spark, star.table, star.evidence()) == summary(spark, star.table)


def test_evidence_gives_the_same_summary_of_broken_tables(spark):
    star = star_over_orders(spark, "/root/testdata/sf0.001")
    found = summary(spark, star.table, star.evidence())
    assert found == summary(spark, star.table)
    assert sum(n > 0 for n, _ in found.values()) > 20
    for kind in rules.GENERIC_PARTS:
        with_it = rules.generic_failures(spark, star.table, kind, star.evidence()).collect()
        assert sorted(with_it) == sorted(rules.generic_failures(spark, star.table, kind).collect())


def test_every_rule_has_its_evidence(star):
    names = set(star.evidence().figures)
    wanted = {rules.generic_name("not_null", t, c) for t, c in rules.generic_rules()["not_null"]}
    assert wanted | set(rules.ROW_RULES) <= names
    keyed = {rules.generic_name(k, t, c) for k in ("unique", "relationships") for t, c in rules.generic_rules()[k]}
    assert len(keyed) == 40 and keyed < set(evidence.KEY_FIGURES)


def test_the_ledger_reads_each_table_once_and_moves_once(spark, star):
    plan = physical(key_ledger(star.table, evidence.USES))
    initial = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
    assert initial.count("FileScan parquet") == len({u.table for u in evidence.USES.values()}) == 15
    assert initial.count("Exchange hashpartitioning(domain") == initial.count("Exchange ") == 1


def test_the_summary_reads_each_fact_once(spark, star):
    """What is left after the evidence: conditions against the encounters' patients."""
    plan = physical(rules.rule_summary(spark, star.table, rules.TOLERATED, star.evidence()))
    initial = plan[plan.index("== Initial Plan ==") :] if "== Initial Plan ==" in plan else plan
    for fact in ("fct_encounter", "fct_condition"):
        assert initial.count(f"/{fact}/") == 1
    assert "array_repeat" not in plan and "CartesianProduct" not in plan


def test_ledger_counts_by_place(spark):
    frames = {
        "a": spark.sql("select * from values ('x'), ('x'), ('y'), (null) as t(k)"),
        "b": spark.sql("select * from values ('x', 1), ('z', 1), ('z', 2) as t(k, other)"),
    }
    uses = {"a.k": Use("a", "k", "k"), "b.k": Use("b", "k", "k"), "b.other": Use("b", "other", "other")}
    ledger = key_ledger(frames.__getitem__, uses)
    figures = {
        "repeated": KeyFigure("k", "if({a.k} > 1, 1L, 0L)"),
        "lost": KeyFigure("k", "if({a.k} = 0, {b.k}, 0L)"),
        "others": KeyFigure("other", "{b.other}"),
    }
    got = {r["name"]: r["n"] for r in key_figures(ledger, uses, figures).collect()}
    assert got == {"repeated": 1, "lost": 2, "others": 3}


def test_null_grains_match_nothing(spark, star):
    def with_null(name):
        rows = star.table(name)
        if name in evidence.GRAIN_TABLES:
            return rows.selectExpr(
                *[f"if(encounter_id = 'E9', null, {c}) as {c}" if c == "condition_code" else c for c in rows.columns]
            )
        return rows

    figures = evidence.KEY_FIGURES["condition_fact_matches_staging_grain"]
    got = key_figures(key_ledger(with_null, evidence.USES), evidence.USES, {"n": figures}).collect()
    assert [r["n"] for r in got] == [rules.condition_fact_matches_staging_grain(with_null).count()] == [2]


def test_a_broken_rule_stops_the_release(spark, built):
    with pytest.raises(rules.RulesBroken) as raised:
        built.release(STRICT)
    assert set(raised.value.rules) == set(rules.TOLERATED)
    assert built.folder.versions() == []
    with pytest.raises(FileNotFoundError):
        PublishedStar(spark, built.folder.path)


def test_warnings_do_not_stop_it(spark, built):
    assert built.release().version == 1
    found = PublishedStar(spark, built.folder.path)
    assert {r.status for r in found.table("rule_summary").collect()} == {"pass", "warn"}
    for name in MODELS:
        assert sorted(map(str, found.table(name).collect())) == sorted(map(str, built.table(name).collect()))
    assert summary(spark, found.table, found.evidence()) == summary(spark, built.table)


def test_a_reader_keeps_its_version_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path)
    folder = TableFolder(spark, path)
    for n in range(1, 4):
        folder.write("a", spark.range(n))
        folder.write("b", spark.range(n))
        if n == 2:
            # Between the writes and the publishing, version 1 is what readers get.
            assert TableFolder(spark, path).manifest().version == 1
        folder.publish(["a", "b"], {"n": n}, keep=2)
        if n == 2:
            reader = folder.manifest()
    now = TableFolder(spark, path).manifest()
    assert (now.version, now.notes, reader.version) == (3, {"n": 3}, 2)
    for manifest in (reader, now):
        assert {folder.read(p).count() for p in manifest.tables.values()} == {manifest.version}
    assert folder.versions() == [2, 3]
    assert len(SharedFiles(spark, path).names(f"{path}/a")) == 2


def test_a_table_two_versions_share_stays(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    folder.write("same", spark.range(5))
    for n in range(4):
        folder.write("other", spark.range(n))
        folder.publish(["same", "other"], {}, keep=1)
    assert folder.versions() == [4]
    assert folder.read(folder.manifest().tables["same"]).count() == 5


def test_two_publishers_do_not_take_one_version(spark, tmp_path):
    folders = [TableFolder(spark, str(tmp_path)) for _ in range(2)]
    for folder in folders:
        folder.write("a", spark.range(1))
    taken = folders[0].publish(["a"], {}).version
    folders[1].versions = lambda: []  # as if it had looked before the other published
    assert folders[1]._files().write_once(folders[1]._manifest(taken), "{}") is False
    assert TableFolder(spark, str(tmp_path)).manifest().tables == folders[0].written


OTHER_PROCESS = """
import sys
from pyspark.sql import SparkSession
from wardstar.plans.star import PublishedStar
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
found = PublishedStar(spark, sys.argv[1])
print("rows", found.table("fct_encounter").count(), len(found.evidence().figures))
"""


def test_another_process_opens_what_was_published(spark, built):
    built.release()
    done = subprocess.run(
        [sys.executable, "-c", OTHER_PROCESS, built.folder.path],
        capture_output=True, text=True, timeout=120, cwd=registry.__file__.rpartition("/")[0],
    )
    rows = built.table("fct_encounter").count()
    assert f"rows {rows} {len(built.figures)}" in done.stdout, done.stderr[-2000:]
    assert set(EVIDENCE) <= set(built.folder.manifest().tables)
