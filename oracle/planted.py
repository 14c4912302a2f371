"""A star whose privacy rules were switched off, to see the checks find it.

The honest star breaks none of its privacy rules, so a check of them returns no
rows. These tables publish every year, age and prefix, on all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.scalars import completed_years

#: The patient of a fact row, as a value no plan takes for the key the rows were dealt
#: out by. Spark 4.1 forgets how a union of two such facts is dealt out where a plan holds
#: the union twice, and fails to zip the two; a join that is not relied on may also be
#: split when one patient holds most rows.
OWN_PATIENT = "concat(patient_id, '') as patient_id"

PLANTED_RULES = (
    "patient_zip3_is_a_permitted_prefix",
    "safe_harbor_age_over_89_is_suppressed",
    "fact_age_and_date_do_not_imply_over_89",
    "fact_age_is_withheld_for_the_protected_cohort",
)


def unprotected(tables: Callable[[str], DataFrame]) -> Callable[[str], DataFrame]:
    """The table lookup with nothing withheld.

    Patients grow with the feeds, but two of their columns are a small part of a
    compressed file, so the planner takes millions of them for a few megabytes. The
    hints keep them from passing through the driver.
    """
    patients = tables("stg_patients")
    births = patients.select("patient_id", "birth_date").hint("shuffle_hash")

    def with_age(name: str, at: str) -> DataFrame:
        fact = tables(name)
        age = F.expr(completed_years("birth_date", at))
        shown = fact.join(births, "patient_id").withColumn("patient_age_years", age)
        return shown.selectExpr(*[OWN_PATIENT if c == "patient_id" else c for c in fact.columns])

    def dim_patient() -> DataFrame:
        dim = tables("dim_patient")
        shown = patients.selectExpr(
            "patient_id",
            "cast(year(birth_date) as bigint) as birth_year",
            "cast(year(death_date) as bigint) as death_year",
            f"{completed_years('birth_date', 'death_date')} as age_at_death_years",
            "substr(zip_code, 1, 3) as zip3",
        )
        replaced = ("birth_year", "death_year", "age_at_death_years", "zip3")
        return dim.drop(*replaced).join(shown.hint("merge"), "patient_id").select(*dim.columns)

    def lookup(name: str) -> DataFrame:
        if name == "dim_patient":
            return dim_patient()
        if name == "fct_encounter":
            return with_age(name, "cast(started_at as date)")
        if name == "fct_condition":
            return with_age(name, "started_date")
        return tables(name)

    return lookup
