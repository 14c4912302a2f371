"""Reports over the star.

Facts are summed by their foreign key before a dimension is looked up, so the
join carries one row per key, however the rows are spread over the keys. The
two facts are only ever combined by their shared dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.functions.scalars import completed_years
from wardstar.operators import profiling as pro
from wardstar.operators.keys import union_all
from wardstar.operators.privacy import protected_cohort, published_periods
from wardstar.operators.quality import to_long


def _summed(rows: DataFrame, keys: tuple[str, ...], *sums: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.expr(s) for s in sums])


def _money(column: str) -> str:
    return f"cast(sum({column}) as {pro.MONEY_SUM}) as {column}"


def payer_mix(fct_encounter: DataFrame, dim_payer: DataFrame) -> DataFrame:
    """Encounters and money by payer category and financial class."""
    by_payer = _summed(
        fct_encounter,
        ("payer_id",),
        "count(*) as encounters",
        "sum(total_claim_cost) as billed",
        "sum(payer_coverage) as covered",
        "sum(uncovered_amount) as uncovered",
    )
    classes = dim_payer.select("payer_id", "payer_category", "payer_financial_class")
    return _summed(
        by_payer.join(classes, "payer_id", "left"),
        ("payer_category", "payer_financial_class"),
        "sum(encounters) as encounters",
        _money("billed"),
        _money("covered"),
        _money("uncovered"),
    )


def money(fct_encounter: DataFrame, stg_encounters: DataFrame) -> DataFrame:
    """Billed, covered and uncovered on the fact against staging."""
    shared = {"billed": "total_claim_cost", "covered": "payer_coverage"}
    on_fact = {**shared, "uncovered": "uncovered_amount"}
    in_staging = {**shared, "uncovered": "total_claim_cost - payer_coverage"}
    return pro.reconciliation(
        pro.totals(fct_encounter, on_fact),
        pro.totals(stg_encounters, in_staging),
        "fact_total",
        "staging_total",
    )


def class_mix(fct_encounter: DataFrame) -> DataFrame:
    return _summed(fct_encounter, ("encounter_class",), "count(*) as encounters")


def condition_tags(fct_condition: DataFrame, dim_condition: DataFrame) -> DataFrame:
    """Conditions and codes by the tag of their label."""
    by_code = _summed(fct_condition, ("condition_code",), "count(*) as conditions")
    tags = dim_condition.select("condition_code", "source_semantic_tag")
    return _summed(
        by_code.join(tags, "condition_code", "left"),
        ("source_semantic_tag",),
        "count(condition_code) as codes",
        "sum(conditions) as conditions",
    )


def top_conditions(fct_condition: DataFrame, dim_condition: DataFrame, k: int = 10) -> DataFrame:
    """The k codes on most rows, ties by code."""
    by_code = _summed(fct_condition, ("condition_code",), "count(*) as conditions")
    labels = dim_condition.select("condition_code", "condition_description")
    return (
        by_code.join(labels, "condition_code", "left")
        .select("condition_code", "condition_description", "conditions")
        .orderBy(F.desc("conditions"), "condition_code")
        .limit(k)
    )


def _across(
    fct_encounter: DataFrame,
    fct_condition: DataFrame,
    keys: tuple[str, str],
    dimension: DataFrame,
    dimension_key: str,
    attribute: str,
) -> DataFrame:
    """Encounters and conditions by an attribute of a dimension both facts refer to.

    Each fact is counted by its own key first, and the counts meet in one column, so
    no fact row is ever joined to a row of the other. Rows whose key the dimension
    lacks, or that have none, are counted under a null attribute, so both columns add
    up to their facts.
    """

    def counted(fact: DataFrame, key: str, encounters: str, conditions: str) -> DataFrame:
        return _summed(
            fact.withColumn("member", F.col(key)),
            ("member",),
            f"{encounters} as encounters",
            f"{conditions} as conditions",
        )

    per_member = counted(fct_encounter, keys[0], "count(*)", "0L").unionByName(
        counted(fct_condition, keys[1], "0L", "count(*)")
    )
    members = dimension.select(F.col(dimension_key).alias("member"), attribute)
    return _summed(
        per_member.join(members, "member", "left"),
        (attribute,),
        "sum(encounters) as encounters",
        "sum(conditions) as conditions",
    )


def drill_across(
    fct_encounter: DataFrame, fct_condition: DataFrame, dim_date: DataFrame, attribute: str
) -> DataFrame:
    """Both facts by one attribute of the calendar, which covers encounter starts."""
    keys = ("date_id", "start_date_id")
    return _across(fct_encounter, fct_condition, keys, dim_date, "date_id", attribute)


def drill_across_patients(
    fct_encounter: DataFrame, fct_condition: DataFrame, dim_patient: DataFrame, attribute: str
) -> DataFrame:
    """Both facts by one attribute of the patient."""
    keys = ("patient_id", "patient_id")
    return _across(fct_encounter, fct_condition, keys, dim_patient, "patient_id", attribute)


def iso_week(fct_encounter: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Encounters and billing per ISO week, keyed on year and week together."""
    per_day = _summed(
        fct_encounter, ("date_id",), "count(*) as encounters", "sum(total_claim_cost) as billed"
    )
    return _summed(
        per_day.join(dim_date.select("date_id", "iso_year_week"), "date_id", "left"),
        ("iso_year_week",),
        "sum(encounters) as encounters",
        _money("billed"),
    )


def utilization_gap(
    fct_encounter: DataFrame, dim_organization: DataFrame, dim_provider: DataFrame
) -> DataFrame:
    """Reported utilization of the directories against counted encounters."""

    def gap(directory: DataFrame, key: str, name: str) -> DataFrame:
        used = _summed(fct_encounter, (key,), "count(*) as used")
        return (
            directory.join(used, key, "left")
            .selectExpr(
                f"'{name}' as directory",
                f"{key} as member_id",
                "cast(source_reported_utilization as bigint) as reported",
                "coalesce(used, 0) as counted",
            )
            .selectExpr("*", "reported - counted as gap")
        )

    return gap(dim_organization, "organization_id", "organization").union(
        gap(dim_provider, "provider_id", "provider")
    )


def code_ambiguity(fct_encounter: DataFrame, dim_encounter_type: DataFrame) -> DataFrame:
    """Encounter codes in more than one class or with more than one spelling."""
    pairs = fct_encounter.select("encounter_code", "encounter_class").distinct()
    classes = _summed(pairs, ("encounter_code",), "count(encounter_class) as class_count")
    return (
        classes.join(dim_encounter_type.drop("encounter_count"), "encounter_code", "left")
        .where("class_count > 1 or source_spelling_count > 1")
        .select(*[c for c in dim_encounter_type.columns if c != "encounter_count"], "class_count")
    )


def provider_coverage(fct_encounter: DataFrame, dim_provider: DataFrame) -> DataFrame:
    """Providers per specialty, and how many an encounter refers to."""
    used = fct_encounter.select("provider_id").distinct().selectExpr("*", "true as is_used")
    return _summed(
        dim_provider.join(used, "provider_id", "left"),
        ("specialty",),
        "count(*) as providers",
        "count(is_used) as referenced_providers",
    )


def suppression(
    dim_patient: DataFrame, fct_encounter: DataFrame, fct_condition: DataFrame
) -> DataFrame:
    """Protected patients, and ages published and withheld on the facts."""

    def figures(rows: DataFrame, counts: dict[str, str]) -> DataFrame:
        one_row = rows.agg(*[F.expr(f"{c} as n{i}") for i, c in enumerate(counts.values())])
        return to_long(one_row, list(counts), key_as="figure", value_as="n")

    parts = [
        figures(
            dim_patient,
            {"patients": "count(*)", "protected patients": "count_if(is_age_90_or_older)"},
        )
    ]
    for label, fact in (("encounters", fct_encounter), ("conditions", fct_condition)):
        counts = {
            f"{label} with an age": "count(patient_age_years)",
            f"{label} with the age withheld": "count_if(patient_age_years is null)",
            f"highest age on {label}": "max(patient_age_years)",
        }
        parts.append(figures(fact, counts))
    return union_all(parts)


def residual_span(
    dim_patient: DataFrame, fct_encounter: DataFrame, fct_condition: DataFrame
) -> DataFrame:
    """Protected patients whose published dates alone span more than 89 years."""
    spans = _summed(
        published_periods(
            {"fct_encounter": fct_encounter, "fct_condition": fct_condition}.__getitem__
        ),
        ("patient_id",),
        "min(least(from_date, to_date)) as first_date",
        "max(greatest(from_date, to_date)) as last_date",
    )
    return (
        protected_cohort(dim_patient)
        .join(spans, "patient_id", "left")
        .selectExpr(f"{completed_years('first_date', 'last_date')} as years")
        .agg(
            F.expr("count(*) as protected_patients"),
            F.expr("count_if(years > 89) as spanning_over_89"),
            F.expr("max(years) as longest_span_years"),
        )
    )
