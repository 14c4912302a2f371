"""One patient, or one encounter, with most of the rows: the joins are split at run time."""

from __future__ import annotations

import re

import pytest
from conftest import condition, encounter, frame, patient

from wardstar.plans import facts, rules
from wardstar.plans.staging import stage
from wardstar.operators.privacy import age_guard

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
HOT = 20_000


@pytest.fixture
def thresholds(spark):
    """The limits of adaptive execution, scaled down to these tables; nothing is broadcast."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def repeated(rows, n, **columns):
    """The rows ``n`` times, some columns changed by SQL over ``i``."""
    more = rows.selectExpr("*", f"explode(sequence(0, {n - 1})) as i")
    return more.selectExpr(*[f"{columns[c]} as `{c}`" if c in columns else f"`{c}`" for c in rows.columns])


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew"))

    def written(name, rows):
        rows.repartition(8).write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    one = frame(spark, "patients", patient("P", "1950-01-01"))
    patients = repeated(one, 300, Id="concat('P', i)", LAST="repeat(sha2(string(i), 256), 4)")
    visit = frame(spark, "encounters", encounter("E", "P", "wellness", "2020-01-01T10:00:00Z", "2020-01-01T11:00:00Z"))
    many = repeated(
        visit, HOT, Id="concat('E', i)", DESCRIPTION="sha2(string(i), 256)",
        PATIENT="if(i % 10 < 8, 'P0', concat('P', i % 300))",
    )
    noted = frame(spark, "conditions", condition("P0", "E0", "A", "2020-01-02", None, "x"))
    notes = repeated(
        noted, HOT, ENCOUNTER=f"if(i % 10 < 8, 'E0', concat('E', i % {HOT}))", CODE="concat('C', i)",
        PATIENT=f"if(i % 10 < 8, 'P0', if((i % {HOT}) % 10 < 8, 'P0', concat('P', (i % {HOT}) % 300)))",
        DESCRIPTION="sha2(string(i), 256)",
    )
    found = {
        "stg_patients": written("p", stage("patients", patients)),
        "stg_encounters": written("e", stage("encounters", many)),
        "stg_conditions": written("c", stage("conditions", notes)),
    }
    found["dim_patient"] = spark.createDataFrame([], "patient_id string, is_age_90_or_older boolean")
    found["age_guard"] = written("g", age_guard(found["stg_patients"], found["dim_patient"]))
    return found


def skewed_joins(rows) -> tuple[int, int]:
    """Rows returned, and joins the final plan marks as split for skew."""
    n = len(rows.collect())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("== Initial Plan ==")]
    return n, len(re.findall(r"Join\(skew=true\)|skew=true", final))


def test_encounters_of_one_patient(thresholds, tables):
    rows = facts.fct_encounter(tables["stg_encounters"], tables["stg_conditions"], tables["age_guard"])
    n, split = skewed_joins(rows)
    assert n == HOT and split >= 1


def test_conditions_of_one_encounter(thresholds, tables):
    rows = facts.fct_condition(tables["stg_conditions"], tables["stg_encounters"], tables["age_guard"])
    n, split = skewed_joins(rows)
    assert n == HOT and split >= 2


def test_facts_joined_to_facts(thresholds, spark, tables):
    found = {
        "fct_encounter": tables["stg_encounters"],
        "fct_condition": tables["stg_conditions"].selectExpr("*", "concat(patient_id, '?') as other")
        .drop("patient_id").withColumnRenamed("other", "patient_id"),
    }
    n, split = skewed_joins(rules.condition_patient_matches_encounter_patient(found.__getitem__))
    assert n == HOT and split == 1
