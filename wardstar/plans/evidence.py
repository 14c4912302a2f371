"""What a build learns about its tables, so that the rules need not read them again.

Rules about single rows are counted while a table is written, by metrics observed in
the write itself: they run after the last shuffle, in the tasks that write, so each
row counts once even where lost work is done again. Rules about keys are answered by
one ledger of all keys. Rules about dates and ages start from one row per patient and
the few fact rows of patients whose bounds allow a violation.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.functions.fixed import RESTRICTED_ZIP3
from wardstar.functions.scalars import is_protected_age, is_zip_prefix, listed
from wardstar.operators import quality
from wardstar.operators.keys import union_all, values
from wardstar.operators.ledger import KeyFigure, Use, key_figures, key_ledger
from wardstar.operators.privacy import flagged_cohort, patient_marks, periods_of
from wardstar.plans import rule_map, rules
from wardstar.plans.staging import STAGED_COLUMNS

#: A feed's key column and the staged column that is the same text on the same rows.
STAGED_KEYS = {
    (f"feed_{feed}", source): (f"stg_{feed}", name)
    for feed, columns in STAGED_COLUMNS.items()
    for source, name, _ in columns
}
GRAIN_TABLES = ("stg_conditions", "fct_condition")


def _grain_key() -> str:
    """The three keys of a condition as one text; it starts with N where one is null."""
    parts = ", ".join(
        f"if({k} is null, '-', concat(length({k}), ':', {k}))" for k in rules.CONDITION_GRAIN
    )
    missing = " or ".join(f"{k} is null" for k in rules.CONDITION_GRAIN)
    return f"concat(if({missing}, 'N', 'K'), {parts})"


def _uses() -> dict[str, Use]:
    """Every key column a rule asks about, by ``table.column``, in the domain of its parent key."""
    found: dict[str, Use] = {}
    for child, key, parent, parent_key in rule_map.RELATIONSHIPS:
        found[f"{child}.{key}"] = Use(child, parent_key, f"`{key}`")
        found[f"{parent}.{parent_key}"] = Use(parent, parent_key, f"`{parent_key}`")
    for table, columns in rule_map.UNIQUE.items():
        for column in columns:
            t, c = STAGED_KEYS.get((table, column), (table, column))
            found.setdefault(f"{t}.{c}", Use(t, c, f"`{c}`"))
    for table in GRAIN_TABLES:
        found[f"{table}.grain"] = Use(table, "condition grain", _grain_key())
    return found


USES = _uses()


def _one_sided(a: str, b: str) -> str:
    """Rows of a key on one side only."""
    return f"if({a} = 0, {b}, 0L) + if({b} = 0, {a}, 0L)"


def _key_figures() -> dict[str, KeyFigure]:
    found: dict[str, KeyFigure] = {}
    for table, columns in rule_map.UNIQUE.items():
        for column in columns:
            t, c = STAGED_KEYS.get((table, column), (table, column))
            per_key = "if({" + f"{t}.{c}" + "} > 1, 1L, 0L)"
            found[rules.generic_name("unique", table, column)] = KeyFigure(USES[f"{t}.{c}"].domain, per_key)
    for child, key, parent, parent_key in rule_map.RELATIONSHIPS:
        per_key = "if({" + f"{parent}.{parent_key}" + "} = 0, {" + f"{child}.{key}" + "}, 0L)"
        found[rules.generic_name("relationships", child, key)] = KeyFigure(parent_key, per_key)
    staged, fact = ("{" + f"{t}.grain" + "}" for t in GRAIN_TABLES)
    grain = "condition grain"
    found["condition_grain_is_unique"] = KeyFigure(grain, f"if({staged} > 1, 1L, 0L)")
    found["condition_fact_grain_is_unique"] = KeyFigure(grain, f"if({fact} > 1, 1L, 0L)")
    found["condition_fact_matches_staging_grain"] = KeyFigure(
        grain, f"if(key like 'N%', {staged} + {fact}, {_one_sided(staged, fact)})"
    )
    found["encounter_fact_matches_staging_grain"] = KeyFigure(
        "encounter_id", _one_sided("{stg_encounters.encounter_id}", "{fct_encounter.encounter_id}")
    )
    return found


KEY_FIGURES = _key_figures()


def key_part(kind: str) -> tuple[dict[str, Use], dict[str, KeyFigure]]:
    """The uses and figures that the generic rules of one kind ask of the ledger."""
    figures = {name: f for name, f in KEY_FIGURES.items() if name.startswith(f"{kind}.")}
    asked = "".join(f.per_key for f in figures.values())
    return {name: use for name, use in USES.items() if "{" + name + "}" in asked}, figures


#: The generic rules that are counted as tables pass, and those counted in the ledger.
OBSERVED_KINDS = {"not_null": rule_map.NOT_NULL, "accepted_values": rule_map.ACCEPTED_VALUES}
KEY_KINDS = ("unique", "relationships")


def observed(table: str) -> dict[str, str]:
    """Figures counted while a table is written, as SQL aggregates."""
    found = {
        rules.generic_name("not_null", table, c): f"count_if(`{c}` is null)"
        for c in rule_map.NOT_NULL.get(table, ())
    }
    for c, allowed in rule_map.ACCEPTED_VALUES.get(table, {}).items():
        found[f"outside.{table}.{c}"] = f"count_if(`{c}` not in ({listed(allowed)}))"
    for name, rule in rules.ROW_RULES.items():
        if rule.table == table:
            found[name] = f"count_if({rule.condition})"
    if table == "dim_patient":
        found["patient_zip3_is_a_permitted_prefix"] = (
            f"count_if(not {is_zip_prefix('zip3')}) + count_if(zip3 in ({listed(RESTRICTED_ZIP3)}))"
        )
        found["over_89.dim_patient"] = " + ".join(
            f"count_if({c})" for c in rules.DIMENSION_OVER_89.values()
        )
    if table in rules.FACT_AGE_OVER_89:
        found[f"over_89.{table}"] = f"count_if({is_protected_age('patient_age_years')})"
    return found


def suspects(marks: DataFrame, tables: rules.Tables) -> DataFrame:
    """Fact rows, counted, of all patients whose bounds allow a rule on dates to break."""
    candidates = [
        rules.over_89_candidates(rules.with_published_year(tables), marks),
        rules.implied_candidates(marks),
        rules.death_dates(tables)
        .join(marks.select("patient_id", "latest_encounter"), "patient_id")
        .where("latest_encounter > death_date"),
    ]
    found = union_all([c.select("patient_id") for c in candidates])
    return periods_of(rules.periods(tables), found)


class Evidence(NamedTuple):
    """Observed figures, the ledger with its uses and figures, patient marks and suspect periods.

    The evidence of the generic rules of one kind holds only what those ask about.
    """

    figures: Mapping[str, int]
    ledger: DataFrame | None = None
    marks: DataFrame | None = None
    suspects: DataFrame | None = None
    uses: Mapping[str, Use] = USES
    key_figures: Mapping[str, KeyFigure] = KEY_FIGURES

    def counts(self, spark: SparkSession, tables: rules.Tables, kind: str | None = None) -> list[DataFrame]:
        """(name, n) rows of the generic rules of one kind, or of every rule."""
        if kind == "not_null":
            return [self._observed(spark, "not_null.")]
        if kind in KEY_KINDS:
            return [self._by_key().where(F.col("name").startswith(f"{kind}."))]
        if kind == "accepted_values":
            return self._outsiders(tables)
        return [
            self._observed(spark, ""),
            self._by_key(),
            *self._outsiders(tables),
            *self._of_patients(spark, tables),
        ]

    def _observed(self, spark: SparkSession, prefix: str) -> DataFrame:
        named = {n: k for n, k in self.figures.items() if n.startswith(prefix)}
        rows = [(n, k) for n, k in named.items() if not n.startswith(("outside.", "over_89."))]
        found = values(spark, rows or [("none", 0)], "name, n")
        return found.selectExpr("name", "cast(n as bigint) as n").where("name != 'none'")

    def _by_key(self) -> DataFrame:
        return key_figures(self.ledger, self.uses, self.key_figures)

    def _outsiders(self, tables: rules.Tables) -> list[DataFrame]:
        """Distinct values outside their lists; only columns seen to hold one are read."""
        found = []
        for table, columns in rule_map.ACCEPTED_VALUES.items():
            tripped = {
                rules.generic_name("accepted_values", table, c): (c, allowed)
                for c, allowed in columns.items()
                if self.figures[f"outside.{table}.{c}"]
            }
            if tripped:
                found.append(quality.outsiders(tables(table), tripped))
        return [quality.distinct_outsiders(union_all(found))] if found else []

    def _of_patients(self, spark: SparkSession, tables: rules.Tables) -> list[DataFrame]:
        """The rules that compare rows of several tables, from counted rows."""
        lost_keys = sum(
            self.figures[rules.generic_name("not_null", t, "encounter_id")]
            for t in ("stg_encounters", "fct_encounter")
        )
        on_rows = sum(n for name, n in self.figures.items() if name.startswith("over_89."))
        known = rules.with_published_year(tables)
        safe_harbor = "safe_harbor_age_over_89_is_suppressed"
        after_death = (
            self.suspects.where("fact = 'fct_encounter'")
            .join(rules.death_dates(tables), "patient_id")
            .where("from_date > death_date")
        )
        withheld = self.marks.join(flagged_cohort(tables("dim_patient")), "patient_id", "left")
        fixed = [("encounter_fact_matches_staging_grain", lost_keys), (safe_harbor, on_rows)]

        def named(rows: DataFrame, name: str, n: str = "1L") -> DataFrame:
            return rows.selectExpr(f"'{name}' as name", f"{n} as n")

        return [
            values(spark, fixed, "name, n").selectExpr("name", "cast(n as bigint) as n"),
            named(rules.dates_over_89(known, self.suspects), safe_harbor, "n"),
            named(known.where(rules.is_over_89("death_date")), safe_harbor),
            named(rules.implied_ages(self.suspects, self.marks), "fact_age_and_date_do_not_imply_over_89", "n"),
            named(after_death, "encounter_start_not_after_patient_death", "n"),
            named(
                withheld,
                "fact_age_is_withheld_for_the_protected_cohort",
                "if(is_protected is null, n_without_age, n_with_age)",
            ),
            named(
                rules.condition_patient_matches_encounter_patient(tables),
                "condition_patient_matches_encounter_patient",
            ),
        ]


def evidence_tables(tables: rules.Tables) -> dict[str, DataFrame]:
    """The tables of the evidence over any lookup, not written."""
    marks = patient_marks(rules.periods(tables))
    return {"key_ledger": key_ledger(tables, USES), "patient_marks": marks, "suspect_periods": suspects(marks, tables)}
