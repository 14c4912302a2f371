"""The bespoke rules: each returns the rows that break it, none when it holds.

Every rule takes a table lookup (name to DataFrame). ``ROW_RULES`` look at one
row of one table, so a summary counts all of them in one scan of that table;
``SET_RULES`` compare rows or tables.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.functions.fixed import (
    FORBIDDEN_PATIENT_COLUMNS,
    PROTECTED_AGE,
    RESTRICTED_ZIP3,
)
from wardstar.functions.scalars import (
    completed_years,
    day,
    days_between,
    is_protected_age,
    is_zip_prefix,
    listed,
    plus_years,
    text,
)
from wardstar.operators import quality
from wardstar.operators.keys import grain_difference, repeat_rows, repeated_keys, union_all
from wardstar.operators.privacy import (
    AGED_FACTS,
    BIRTH_BOUND,
    flagged_cohort,
    patient_marks,
    periods_of,
    published_periods,
)
from wardstar.plans import rule_map

if TYPE_CHECKING:
    from wardstar.plans.evidence import Evidence

Tables = Callable[[str], DataFrame]


class RowRule(NamedTuple):
    """Rows of one table for which a condition, in SQL, is true."""

    table: str
    columns: tuple[str, ...]
    condition: str


_ENCOUNTER_DAY, _DISCHARGE_DAY = day("started_at"), day("stopped_at")

ROW_RULES: dict[str, RowRule] = {
    "condition_stop_not_before_start": RowRule(
        "stg_conditions",
        ("patient_id", "encounter_id", "condition_code", "started_date", "stopped_date"),
        "stopped_date < started_date",
    ),
    "encounter_stop_not_before_start": RowRule(
        "stg_encounters",
        ("encounter_id", "started_at", "stopped_at"),
        "stopped_at < started_at",
    ),
    "patient_death_not_before_birth": RowRule(
        "stg_patients",
        ("patient_id", "birth_date", "death_date"),
        "death_date < birth_date",
    ),
    "encounter_payer_coverage_within_claim_cost": RowRule(
        "stg_encounters",
        ("encounter_id", "total_claim_cost", "payer_coverage"),
        "payer_coverage > total_claim_cost",
    ),
    "uncovered_amount_not_negative": RowRule(
        "fct_encounter",
        ("encounter_id", "total_claim_cost", "payer_coverage", "uncovered_amount"),
        "uncovered_amount < 0",
    ),
    "encounter_reason_is_coded_and_labeled": RowRule(
        "stg_encounters",
        ("encounter_id", "reason_code", "reason_description"),
        "isnull(reason_code) != isnull(reason_description)",
    ),
    "length_of_stay_is_inpatient_only": RowRule(
        "fct_encounter",
        ("encounter_id", "encounter_class", "length_of_stay_days"),
        "not ((encounter_class = 'inpatient') <=> isnotnull(length_of_stay_days))",
    ),
    "inpatient_length_of_stay_is_plausible": RowRule(
        "fct_encounter",
        ("encounter_id", "patient_id", "started_at", "stopped_at", "length_of_stay_days"),
        f"isnotnull(length_of_stay_days) and {_DISCHARGE_DAY} > {plus_years(_ENCOUNTER_DAY, 1)}",
    ),
}


def broken_rows(rule: RowRule, tables: Tables) -> DataFrame:
    return tables(rule.table).where(rule.condition).select(*rule.columns)


CONDITION_GRAIN = ("patient_id", "encounter_id", "condition_code")


def condition_grain_is_unique(tables: Tables) -> DataFrame:
    return repeated_keys(tables("stg_conditions"), *CONDITION_GRAIN)


def condition_fact_grain_is_unique(tables: Tables) -> DataFrame:
    return repeated_keys(tables("fct_condition"), *CONDITION_GRAIN)


def condition_fact_matches_staging_grain(tables: Tables) -> DataFrame:
    return grain_difference(tables("stg_conditions"), tables("fct_condition"), *CONDITION_GRAIN)


def encounter_fact_matches_staging_grain(tables: Tables) -> DataFrame:
    return grain_difference(tables("stg_encounters"), tables("fct_encounter"), "encounter_id")


def condition_patient_matches_encounter_patient(tables: Tables) -> DataFrame:
    """Condition rows filed under another patient than their encounter."""
    seen = tables("fct_encounter").selectExpr(
        "encounter_id", "patient_id as encounter_patient_id"
    )
    return (
        tables("fct_condition")
        .join(seen, "encounter_id")
        .where("patient_id != encounter_patient_id")
        .selectExpr(
            "encounter_id",
            "condition_code",
            "patient_id as condition_patient_id",
            "encounter_patient_id",
        )
    )


def death_dates(tables: Tables) -> DataFrame:
    return tables("stg_patients").where("death_date is not null").select("patient_id", "death_date")


def encounter_start_not_after_patient_death(tables: Tables) -> DataFrame:
    return (
        tables("fct_encounter")
        .selectExpr("encounter_id", "patient_id", f"{_ENCOUNTER_DAY} as encounter_date")
        .join(death_dates(tables), "patient_id")
        .where("encounter_date > death_date")
        .selectExpr(
            "encounter_id",
            "patient_id",
            "encounter_date",
            "death_date",
            f"{days_between('death_date', 'encounter_date')} as days_after_death",
        )
    )


def forbidden_columns(spark: SparkSession, published: DataFrame) -> DataFrame:
    """Columns of the published patient table that must not exist."""
    found = [(c,) for c in published.schema.fieldNames() if c in FORBIDDEN_PATIENT_COLUMNS]
    return spark.createDataFrame(found, "column_name string")


def patient_zip3_is_a_permitted_prefix(tables: Tables) -> DataFrame:
    """Published prefixes of the wrong shape, and restricted ones."""
    problems = f"""explode(array_compact(array(
        if(not {is_zip_prefix('zip3')}, 'not a three-digit prefix', null),
        if(zip3 in ({listed(RESTRICTED_ZIP3)}), 'restricted prefix published', null))))"""
    return tables("dim_patient").selectExpr("patient_id", "zip3", f"{problems} as violation")


#: The texts of the violations of an age over 89.
YEAR_RETAINED = "year element retained for an over-89 patient"
AGE_AT_DEATH_ABOVE = "age_at_death_years above the aggregated category"
DATE_OVER_89 = "a published date puts this patient over 89"
FACT_AGE_OVER_89 = {
    p.fact: f"patient_age_years over 89 on the {p.label} fact" for p in AGED_FACTS
}
#: Conditions on one row of the dimension, by their text.
DIMENSION_OVER_89 = {
    YEAR_RETAINED: "is_age_90_or_older and (isnotnull(birth_year) or isnotnull(death_year))",
    AGE_AT_DEATH_ABOVE: f"age_at_death_years > {PROTECTED_AGE}",
}


def is_over_89(date: str) -> str:
    return is_protected_age(completed_years("birth_date", date))


def periods(tables: Tables) -> DataFrame:
    return published_periods(tables)


def with_published_year(tables: Tables) -> DataFrame:
    """Patients whose birth year is published, with their dates of birth and death.

    Either side can hold most patients and looks small to the planner, being a few
    columns of a compressed file, so neither may be broadcast.
    """
    dates = tables("stg_patients").select("patient_id", "birth_date", "death_date")
    return (
        tables("dim_patient")
        .where("birth_year is not null")
        .select("patient_id")
        .join(dates.hint("merge"), "patient_id")
    )


def over_89_candidates(known: DataFrame, marks: DataFrame) -> DataFrame:
    """Of the patients of ``with_published_year``, those whose latest date is over 89."""
    return known.join(marks.select("patient_id", "latest_date"), "patient_id").where(
        is_over_89("latest_date")
    )


def dates_over_89(known: DataFrame, counted: DataFrame) -> DataFrame:
    """(patient_id, n): published dates at which the patient is over 89, per patient and day."""
    return (
        counted.selectExpr(
            "patient_id", "explode(array_compact(array(from_date, to_date))) as published_date", "n"
        )
        .groupBy("patient_id", "published_date")
        .agg(F.expr("sum(n) as n"))
        .join(known, "patient_id")
        .where(is_over_89("published_date"))
        .select("patient_id", "n")
    )


def safe_harbor_age_over_89_is_suppressed(tables: Tables) -> DataFrame:
    """The ways a published age or year still shows an age over 89.

    Age grows with the date, so only patients over 89 at their latest published date
    can break the clause on dates; only their fact rows are grouped by day.
    """
    problems = ", ".join(f"if({c}, {text(v)}, null)" for v, c in DIMENSION_OVER_89.items())
    parts = [
        tables("dim_patient").selectExpr(
            "patient_id", f"explode(array_compact(array({problems}))) as violation"
        )
    ]
    known, rows = with_published_year(tables), periods(tables)
    candidates = over_89_candidates(known, patient_marks(rows))
    by_date = repeat_rows(dates_over_89(known, periods_of(rows, candidates)), "n")
    parts.append(
        by_date.union(known.where(is_over_89("death_date")).select("patient_id")).selectExpr(
            "patient_id", f"{text(DATE_OVER_89)} as violation"
        )
    )
    for name, violation in FACT_AGE_OVER_89.items():
        parts.append(
            tables(name)
            .where(is_protected_age("patient_age_years"))
            .selectExpr("patient_id", f"{text(violation)} as violation")
        )
    return union_all(parts)


_IMPLIED = is_protected_age(completed_years("birth_bound", "latest_date"))


def implied_candidates(marks: DataFrame) -> DataFrame:
    """Patients whose earliest birth bound puts them over 89 at their latest date."""
    return marks.where(_IMPLIED)


def implied_ages(counted: DataFrame, marks: DataFrame) -> DataFrame:
    """Published ages, counted, that imply an age over 89 at the patient's latest date."""
    anchors = (
        counted.where("patient_age_years is not null")
        .groupBy("patient_id", "patient_age_years", "from_date")
        .agg(F.expr("sum(n) as n"))
        .withColumn("birth_bound", F.expr(BIRTH_BOUND))
    )
    return (
        anchors.join(marks.select("patient_id", "latest_date"), "patient_id")
        .where(_IMPLIED)
        .selectExpr(
            "patient_id",
            "patient_age_years as anchor_age",
            "from_date as anchor_date",
            "n",
            "latest_date",
            f"{completed_years('birth_bound', 'latest_date')} as implied_age",
        )
    )


def fact_age_and_date_do_not_imply_over_89(tables: Tables) -> DataFrame:
    """Published ages that, with the patient's latest published date, show over 89.

    An age at a date bounds the birth from above; the bound is an age at the
    latest date. Uses published columns only, never the cohort. The earliest bound of
    a patient decides whether any of their rows can break the rule.
    """
    rows = periods(tables)
    marks = patient_marks(rows)
    counted = periods_of(rows, implied_candidates(marks))
    return repeat_rows(implied_ages(counted, marks), "n")


def fact_age_is_withheld_for_the_protected_cohort(tables: Tables) -> DataFrame:
    """Fact rows with an age on a protected patient, or none on another."""

    both = union_all(
        [
            tables(p.fact).selectExpr(
                f"'{p.fact}' as fact", f"{p.row_key} as row_key", "patient_id", "patient_age_years"
            )
            for p in AGED_FACTS
        ]
    )
    return (
        both.join(flagged_cohort(tables("dim_patient")), "patient_id", "left")
        .where("isnotnull(is_protected) != isnull(patient_age_years)")
        .select("fact", "row_key", "patient_id", "patient_age_years")
    )


SET_RULES: dict[str, Callable[[Tables], DataFrame]] = {
    "condition_grain_is_unique": condition_grain_is_unique,
    "condition_fact_grain_is_unique": condition_fact_grain_is_unique,
    "condition_fact_matches_staging_grain": condition_fact_matches_staging_grain,
    "encounter_fact_matches_staging_grain": encounter_fact_matches_staging_grain,
    "condition_patient_matches_encounter_patient": condition_patient_matches_encounter_patient,
    "encounter_start_not_after_patient_death": encounter_start_not_after_patient_death,
    "patient_zip3_is_a_permitted_prefix": patient_zip3_is_a_permitted_prefix,
    "safe_harbor_age_over_89_is_suppressed": safe_harbor_age_over_89_is_suppressed,
    "fact_age_and_date_do_not_imply_over_89": fact_age_and_date_do_not_imply_over_89,
    "fact_age_is_withheld_for_the_protected_cohort": (
        fact_age_is_withheld_for_the_protected_cohort
    ),
}

# Known defects are tolerated up to these counts, as (warn above,
# error above). Every other rule fails on the first row.
TOLERATED: dict[str, tuple[int, int]] = {
    "encounter_start_not_after_patient_death": (0, 165),
    "inpatient_length_of_stay_is_plausible": (0, 1),
}


def rule_rows(name: str, tables: Tables) -> DataFrame:
    """The violating rows of one bespoke rule."""
    if name in ROW_RULES:
        return broken_rows(ROW_RULES[name], tables)
    return SET_RULES[name](tables)


def generic_name(kind: str, table: str, column: str) -> str:
    """The name of a generic rule in a summary."""
    return f"{kind}.{table}.{column}"


def not_null_parts(tables: Tables) -> list[DataFrame]:
    return [
        quality.nulls(tables(t), {generic_name("not_null", t, c): c for c in columns})
        for t, columns in rule_map.NOT_NULL.items()
    ]


def unique_parts(tables: Tables) -> list[DataFrame]:
    scans = [
        (tables(t), {generic_name("unique", t, c): c for c in columns})
        for t, columns in rule_map.UNIQUE.items()
    ]
    return [quality.repeats(scans)]


def relationship_parts(tables: Tables) -> list[DataFrame]:
    children: dict[str, dict[str, tuple[str, str]]] = {}
    parents: dict[str, tuple[DataFrame, str]] = {}
    for child, key, parent, parent_key in rule_map.RELATIONSHIPS:
        name = generic_name("relationships", child, key)
        children.setdefault(child, {})[name] = (key, parent)
        parents.setdefault(parent, (tables(parent), parent_key))
    return [quality.orphans([(tables(c), refs) for c, refs in children.items()], parents)]


def accepted_value_parts(tables: Tables) -> list[DataFrame]:
    found = [
        quality.outsiders(
            tables(t),
            {generic_name("accepted_values", t, c): (c, values) for c, values in columns.items()},
        )
        for t, columns in rule_map.ACCEPTED_VALUES.items()
    ]
    return [quality.distinct_outsiders(union_all(found))]


GENERIC_PARTS: dict[str, Callable[[Tables], list[DataFrame]]] = {
    "not_null": not_null_parts,
    "unique": unique_parts,
    "relationships": relationship_parts,
    "accepted_values": accepted_value_parts,
}


def generic_rules() -> dict[str, list[tuple[str, str]]]:
    """Table and column of every generic rule, by kind."""
    return {
        "not_null": [(t, c) for t, columns in rule_map.NOT_NULL.items() for c in columns],
        "unique": [(t, c) for t, columns in rule_map.UNIQUE.items() for c in columns],
        "relationships": [(child, key) for child, key, _, _ in rule_map.RELATIONSHIPS],
        "accepted_values": [
            (t, c) for t, columns in rule_map.ACCEPTED_VALUES.items() for c in columns
        ],
    }


def generic_failures(
    spark: SparkSession, tables: Tables, kind: str, evidence: Evidence | None = None
) -> DataFrame:
    """Every generic rule of one kind with its failures.

    With the evidence of a build the tables are not read again for them.
    """
    names = [generic_name(kind, t, c) for t, c in generic_rules()[kind]]
    parts = evidence.counts(spark, tables, kind) if evidence else GENERIC_PARTS[kind](tables)
    counts = quality.tally(spark, names, parts)
    return counts.selectExpr(
        "split_part(name, '.', 2) as table_name",
        "split_part(name, '.', 3) as column_name",
        "split_part(name, '.', 1) as rule",
        "violations",
    )


def bespoke_parts(tables: Tables) -> list[DataFrame]:
    """(name, n) rows of the bespoke rules; one scan per table for row rules."""
    by_table: dict[str, dict[str, str]] = {}
    for name, rule in ROW_RULES.items():
        by_table.setdefault(rule.table, {})[name] = rule.condition
    parts = [quality.failures(tables(t), conditions) for t, conditions in by_table.items()]
    parts += [
        rule(tables).selectExpr(f"{text(name)} as name", "1L as n")
        for name, rule in SET_RULES.items()
    ]
    return parts


COLUMN_RULE = "patient_dimension_excludes_name_place_and_date_columns"


def rule_summary(
    spark: SparkSession,
    tables: Tables,
    tolerated: dict[str, tuple[int, int]] = TOLERATED,
    evidence: Evidence | None = None,
) -> DataFrame:
    """Every rule with its violations and its status.

    Without evidence every rule reads its tables; with the evidence of a build, which
    holds for exactly these tables, most are answered from figures it left.
    """
    names = [generic_name(kind, t, c) for kind, pairs in generic_rules().items() for t, c in pairs]
    names += [*ROW_RULES, *SET_RULES, COLUMN_RULE]
    if evidence:
        parts = evidence.counts(spark, tables)
    else:
        parts = [part for make in GENERIC_PARTS.values() for part in make(tables)]
        parts += bespoke_parts(tables)
    columns = forbidden_columns(spark, tables("dim_patient"))
    parts.append(columns.selectExpr(f"{text(COLUMN_RULE)} as name", "1L as n"))
    return with_status(quality.tally(spark, names, parts), tolerated)


def with_status(counts: DataFrame, tolerated: dict[str, tuple[int, int]]) -> DataFrame:
    """Counts with thresholds and pass, warn or error."""

    def limit(position: int) -> str:
        known = "".join(f"when {text(n)} then {t[position]}L " for n, t in tolerated.items())
        return f"case name {known}else 0L end" if known else "0L"

    return counts.selectExpr(
        "name as rule",
        "violations",
        f"{limit(0)} as warn_if",
        f"{limit(1)} as error_if",
    ).selectExpr("*", f"{quality.status('violations', 'warn_if', 'error_if')} as status")


class RulesBroken(Exception):
    """Rules with status ``error``; ``rules`` has their names and violations."""

    def __init__(self, broken: dict[str, int]):
        super().__init__(", ".join(f"{name}: {n}" for name, n in broken.items()))
        self.rules = broken


def gate(summary: DataFrame) -> DataFrame:
    """The summary, if no rule in it has status ``error``."""
    broken = summary.where("status = 'error'").orderBy("rule").select("rule", "violations")
    if found := {r.rule: r.violations for r in broken.collect()}:
        raise RulesBroken(found)
    return summary
