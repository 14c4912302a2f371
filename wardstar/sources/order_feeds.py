"""Order tables seen as raw clinical feeds.

The sample tables hold customers, orders and lines instead of patients,
encounters and conditions. These projections give every row of them the feed
shape, all text, so that staging, models, rules and reports run unchanged on
data of any size. Defects a real feed can carry (unresolved keys, reversed
periods, missing halves of a pair, unknown categories) are planted by key, and
one payer and one code hold about a third of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.sources.feeds import LazyFeeds
from wardstar.sources.tables import spread


# Keys that deal a table out evenly; the others are small directories.
_EVEN_KEYS = {
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_partkey"),
    "events": ("event_id",),
}


def order_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """The Parquet tables in ``sf_dir`` by name, on all cores."""

    def table(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return spread(rows, *_EVEN_KEYS[name]) if name in _EVEN_KEYS else rows

    return table


def order_feeds(spark: SparkSession, sf_dir: str) -> LazyFeeds:
    """The nine raw feeds over the Parquet tables in ``sf_dir``."""
    table = order_tables(spark, sf_dir)
    return LazyFeeds(lambda feed: _BUILDERS[feed](table))


def _patients(table) -> DataFrame:
    return table("customer").selectExpr(
        "cast(c_custkey as string) as Id",
        """case when c_custkey % 997 != 13 then
             cast(date_add(date'1905-01-01', cast(c_custkey * 7919 % 32000 as int)) as string)
           end as BIRTHDATE""",
        """case
             when c_custkey % 211 = 5 then cast(date_add(date'1905-01-01',
               cast(c_custkey * 7919 % 32000 - 30 as int)) as string)
             when c_custkey % 7 = 0 then
               cast(date_add(date'1999-01-01', cast(c_custkey * 31 % 900 as int)) as string)
           end as DEATHDATE""",
        "concat('999-00-', c_custkey) as SSN",
        "concat('S', c_custkey) as DRIVERS",
        "concat('X', c_custkey) as PASSPORT",
        "case when c_custkey % 2 = 0 then 'Mr.' else 'Ms.' end as PREFIX",
        "concat('First', c_custkey) as FIRST",
        "c_name as LAST",
        "cast(null as string) as SUFFIX",
        "case when c_custkey % 4 = 1 then concat('Maiden', c_custkey) end as MAIDEN",
        """case when c_custkey % 457 = 11 then 'D' when c_custkey % 3 = 0 then 'M'
             when c_custkey % 3 = 1 then 'S' end as MARITAL""",
        """case c_custkey % 6 when 0 then 'white' when 1 then 'black' when 2 then 'asian'
             when 3 then 'hawaiian' when 4 then 'native' else 'other' end as RACE""",
        "case when c_custkey % 5 = 0 then 'hispanic' else 'nonhispanic' end as ETHNICITY",
        "case when c_custkey % 2 = 0 then 'M' else 'F' end as GENDER",
        "concat('Nation ', c_nationkey) as BIRTHPLACE",
        "concat(c_custkey, ' Main Street') as ADDRESS",
        "concat('City ', c_custkey % 50) as CITY",
        "'MA' as STATE",
        "concat('County ', c_custkey % 14) as COUNTY",
        """case when c_custkey % 3 = 0 then null when c_custkey % 499 = 7 then '1A309'
             else lpad(cast(c_custkey * 37 % 100000 as string), 5, '0') end as ZIP""",
        "concat('42.', lpad(cast(c_custkey % 10000 as string), 4, '0')) as LAT",
        "concat('-71.', lpad(cast(c_custkey * 3 % 10000 as string), 4, '0')) as LON",
        "cast(cast(c_acctbal as decimal(18,2)) as string) as HEALTHCARE_EXPENSES",
        "cast(cast(floor(c_acctbal) as bigint) as string) as HEALTHCARE_COVERAGE",
    )


# Seconds between the start and the stop of an encounter.
_STAY_SECONDS = """case
    when o_orderkey % 1009 = 17 then -60
    when o_orderpriority = '1-URGENT' and o_orderkey % 997 = 0 then 35000000
    when o_orderpriority = '1-URGENT' then 43200 + o_orderkey * 613 % 400000
    else 600 + o_orderkey * 613 % 7200 end"""


def _utc_text(seconds: str) -> str:
    moment = f"o_orderdate + make_dt_interval(0, 0, 0, {seconds})"
    return f"concat(replace(cast({moment} as string), ' ', 'T'), 'Z')"


def _encounters(table) -> DataFrame:
    return (
        table("orders")
        .selectExpr(
            "*",
            "o_orderkey * 7919 % 86400 as start_second",
            f"{_STAY_SECONDS} as stay_seconds",
            "case when o_orderkey % 3 = 0 then 7 else o_orderkey % 23 end as code",
            """case when o_orderkey % 1601 = 11 then '99' when o_orderkey % 1709 = 13 then null
                 when o_orderkey % 3 = 0 then '9'
                 else cast(o_orderkey % 25 as string) end as payer""",
        )
        .selectExpr(
            "cast(o_orderkey as string) as Id",
            """case when o_orderkey % 1511 = 9 then concat('missing-', o_custkey)
                 else cast(o_custkey as string) end as PATIENT""",
            "cast(o_custkey div 15 as string) as ORGANIZATION",
            "cast(o_custkey div 15 * 20 + o_custkey % 15 as string) as PROVIDER",
            "payer as PAYER",
            f"{_utc_text('start_second')} as START",
            f"{_utc_text('start_second + stay_seconds')} as STOP",
            """case when o_orderkey % 1201 = 3 then null when o_orderkey % 1301 = 5 then 'virtual'
                 else case substr(o_orderpriority, 1, 1) when '1' then 'inpatient'
                   when '2' then 'emergency' when '3' then 'outpatient'
                   when '4' then 'ambulatory' else 'wellness' end end as ENCOUNTERCLASS""",
            "cast(code as string) as CODE",
            """concat(case when code % 4 = 3 and o_orderkey % 10 < 3 then 'ENCOUNTER TYPE '
                 else 'Encounter type ' end, code) as DESCRIPTION""",
            """case when o_orderkey % 4 = 0 or o_orderkey % 1801 = 15
                 then concat('R', o_orderkey % 40) end as REASONCODE""",
            """case when o_orderkey % 4 = 0
                 then concat('Reason ', o_orderkey % 40) end as REASONDESCRIPTION""",
            "case when o_orderkey % 2 = 0 then '129.16' else '77.49' end as BASE_ENCOUNTER_COST",
            "cast(cast(o_totalprice as decimal(18,2)) as string) as TOTAL_CLAIM_COST",
            """case when o_orderkey % 1901 = 21
                   then cast(cast(floor(o_totalprice) as bigint) + 100 as string)
                 when payer = '9' then '0.00'
                 else cast(cast(floor(o_totalprice * 0.6) as bigint) as string)
               end as PAYER_COVERAGE""",
        )
    )


def _lines(table) -> DataFrame:
    """Every line with the customer and day of its order."""
    heads = table("orders").selectExpr(
        "o_orderkey", "o_custkey", "cast(o_orderdate as date) as order_day"
    )
    return table("lineitem").join(heads, F.col("l_orderkey") == F.col("o_orderkey"))


def _conditions(table) -> DataFrame:
    return (
        _lines(table)
        .selectExpr(
            "*",
            """date_add(order_day,
                 cast(l_orderkey * l_linenumber * 13 % 41 - 8 as int)) as onset""",
            """case when (l_orderkey + l_linenumber) % 3 = 0 then 0
                 else l_partkey % 200 end as code""",
        )
        .selectExpr(
            """case when (l_orderkey + l_linenumber) % 2003 = 1 then cast(o_custkey + 1 as string)
                 when (l_orderkey + l_linenumber) % 2017 = 5 then concat('missing-', o_custkey)
                 else cast(o_custkey as string) end as PATIENT""",
            "cast(l_orderkey as string) as ENCOUNTER",
            "cast(onset as string) as START",
            """case when l_returnflag = 'N' then null
                 when l_partkey % 2011 = 2 then cast(date_add(onset, -1) as string)
                 else cast(date_add(onset, cast(l_quantity as int) * 11) as string)
               end as STOP""",
            "cast(code as string) as CODE",
            """concat(case when l_partkey % 40 = 0 and l_linenumber <= 2 then 'CONDITION '
                 else 'Condition ' end, code,
               case code % 3 when 0 then ' (finding)' when 1 then ' (disorder)'
                 else '' end) as DESCRIPTION""",
        )
    )


def _organizations(table) -> DataFrame:
    return table("supplier").selectExpr(
        "cast(s_suppkey as string) as Id",
        "concat('  ', s_name, '  ', chr(9), ' Hospital ') as NAME",
        "concat(s_suppkey, ' Care Road') as ADDRESS",
        "concat('City ', s_nationkey) as CITY",
        "case when s_suppkey % 41 = 3 then 'NH' else 'MA' end as STATE",
        "lpad(cast(s_suppkey * 53 % 100000 as string), 5, '0') as ZIP",
        "concat('42.', lpad(cast(s_suppkey % 10000 as string), 4, '0')) as LAT",
        "concat('-71.', lpad(cast(s_suppkey * 7 % 10000 as string), 4, '0')) as LON",
        "concat('555-', lpad(cast(s_suppkey % 10000 as string), 4, '0')) as PHONE",
        "cast(cast(s_acctbal as decimal(18,2)) as string) as REVENUE",
        "cast(s_suppkey * 41 % 1000 as string) as UTILIZATION",
    )


def _providers(table) -> DataFrame:
    return table("part").selectExpr(
        "cast(p_partkey as string) as Id",
        """case when p_partkey % 503 = 4 then concat('gone-', p_partkey)
             else cast(p_partkey div 20 as string) end as ORGANIZATION""",
        "concat(p_name, ' ', p_partkey) as NAME",
        "case when p_partkey % 2 = 0 then 'M' else 'F' end as GENDER",
        "case when p_partkey % 3 = 0 then 'GENERAL PRACTICE' else p_type end as SPECIALITY",
        "concat(p_partkey div 20, ' Care Road') as ADDRESS",
        "concat('City ', p_partkey % 50) as CITY",
        "'MA' as STATE",
        "lpad(cast(p_partkey * 53 % 100000 as string), 5, '0') as ZIP",
        "concat('42.', lpad(cast(p_partkey % 10000 as string), 4, '0')) as LAT",
        "concat('-71.', lpad(cast(p_partkey * 7 % 10000 as string), 4, '0')) as LON",
        "cast(p_size as string) as UTILIZATION",
    )


def _payers(table) -> DataFrame:
    """One payer per nation, its totals counted from the nation's customers."""
    totals = (
        table("customer")
        .selectExpr(
            "c_nationkey",
            "c_mktsegment",
            "cast(c_acctbal as decimal(18,2)) as balance",
        )
        .groupBy("c_nationkey")
        .agg(
            *[
                F.expr(text)
                for text in (
                    "sum(greatest(balance, 0)) as covered",
                    "sum(greatest(-balance, 0)) as uncovered",
                    "sum(balance) as revenue",
                    "count_if(balance >= 0) as covered_rows",
                    "count_if(balance < 0) as uncovered_rows",
                    "count_if(c_mktsegment = 'BUILDING') as building",
                    "count_if(c_mktsegment = 'MACHINERY') as machinery",
                    "count(*) as customers",
                )
            ]
        )
    )
    return (
        table("nation")
        .join(totals, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .selectExpr(
            "cast(n_nationkey as string) as Id",
            """case n_nationkey when 6 then 'Medicare' when 7 then 'Medicaid'
                 when 8 then 'Dual Eligible' when 9 then 'NO_INSURANCE'
                 else n_name end as NAME""",
            "case when n_nationkey != 9 then concat(n_nationkey, ' Plan Street') end as ADDRESS",
            "case when n_nationkey != 9 then concat('City ', n_nationkey) end as CITY",
            "case when n_nationkey != 9 then concat('S', n_regionkey) end as STATE_HEADQUARTERED",
            """case when n_nationkey != 9 then
                 lpad(cast(n_nationkey * 53 as string), 5, '0') end as ZIP""",
            """case when n_nationkey != 9 then
                 concat('555-', lpad(cast(n_nationkey as string), 4, '0')) end as PHONE""",
            "cast(cast(coalesce(covered, 0) as decimal(18,2)) as string) as AMOUNT_COVERED",
            "cast(cast(coalesce(uncovered, 0) as decimal(18,2)) as string) as AMOUNT_UNCOVERED",
            "cast(cast(coalesce(revenue, 0) as decimal(18,2)) as string) as REVENUE",
            "cast(coalesce(covered_rows, 0) as string) as COVERED_ENCOUNTERS",
            "cast(coalesce(uncovered_rows, 0) as string) as UNCOVERED_ENCOUNTERS",
            "cast(coalesce(building, 0) as string) as COVERED_MEDICATIONS",
            "cast(coalesce(machinery, 0) as string) as UNCOVERED_MEDICATIONS",
            "cast(coalesce(building, 0) as string) as COVERED_PROCEDURES",
            "cast(coalesce(machinery, 0) as string) as UNCOVERED_PROCEDURES",
            "cast(coalesce(building, 0) as string) as COVERED_IMMUNIZATIONS",
            "cast(coalesce(machinery, 0) as string) as UNCOVERED_IMMUNIZATIONS",
            "cast(coalesce(customers, 0) as string) as UNIQUE_CUSTOMERS",
            "cast(coalesce(customers, 0) as string) as MEMBER_MONTHS",
            "concat('0.', lpad(cast(n_nationkey as string), 2, '0')) as QOLS_AVG",
        )
    )


def _claims(table) -> DataFrame:
    return _lines(table).selectExpr(
        "concat(l_orderkey, '-', l_linenumber) as Id",
        "cast(o_custkey as string) as PATIENTID",
        "cast(l_partkey as string) as PROVIDERID",
        "cast(null as string) as REFERRINGPROVIDERID",
        """case when l_orderkey % 3 = 0
             then cast(l_partkey * 2 as string) end as SUPERVISINGPROVIDERID""",
        """case when l_orderkey % 101 = 0 then concat('x', l_orderkey)
             when l_orderkey % 50 != 0 then cast(l_orderkey as string) end as APPOINTMENTID""",
        "case when l_orderkey % 3 = 0 then '0' else '7' end as PRIMARYPATIENTINSURANCEID",
        """case when l_linenumber = 3 and l_orderkey % 11 = 0
             then '2' else '1' end as HEALTHCARECLAIMTYPEID1""",
        "case when l_linenumber % 2 = 1 then '0' end as HEALTHCARECLAIMTYPEID2",
    )


def _claims_transactions(table) -> DataFrame:
    return (
        _lines(table)
        .selectExpr(
            "*",
            "cast(cast(l_extendedprice as decimal(18,2)) as string) as money",
            """case when l_linenumber = 7 and l_returnflag = 'N' then null
                 when l_returnflag = 'A' then 'CHARGE' when l_returnflag = 'N' then 'TRANSFERIN'
                 when l_linestatus = 'F' then 'PAYMENT' else 'TRANSFEROUT' end as kind""",
        )
        .selectExpr(
            """concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                 cast(l_shipdate as date)) as ID""",
            """case when l_suppkey % 10 = 3 then concat('gone-', l_orderkey)
                 else concat(l_orderkey, '-', l_linenumber) end as CLAIMID""",
            "cast(o_custkey as string) as PATIENTID",
            "cast(l_partkey as string) as PROVIDERID",
            """case when l_orderkey % 3 = 0
                 then cast(l_suppkey as string) end as SUPERVISINGPROVIDERID""",
            "cast(l_orderkey as string) as APPOINTMENTID",
            "kind as TYPE",
            "case when kind = 'CHARGE' then money end as AMOUNT",
            "case when kind = 'PAYMENT' then money end as PAYMENTS",
            "case when kind in ('TRANSFERIN', 'TRANSFEROUT') then money end as TRANSFERS",
        )
    )


def _payer_transitions(table) -> DataFrame:
    return table("events").selectExpr(
        "case when event_id % 3 = 0 then '9' else cast(user_id % 25 as string) end as PAYER",
        """case when event_type = 'purchase'
             then cast(user_id * 3 % 26 as string) end as SECONDARY_PAYER""",
    )


_BUILDERS = {
    "claims": _claims,
    "claims_transactions": _claims_transactions,
    "conditions": _conditions,
    "encounters": _encounters,
    "organizations": _organizations,
    "patients": _patients,
    "payer_transitions": _payer_transitions,
    "payers": _payers,
    "providers": _providers,
}
