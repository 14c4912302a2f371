"""SQL statements DuckDB runs on the order tables to check every query.

Written apart from the Spark code: typed staging comes straight from the order
tables, labels from ordered lists, ages from month-and-day text.
"""

from __future__ import annotations

import re

from wardstar.functions.fixed import RESTRICTED_ZIP3
from wardstar.plans import rule_map

ZIPS = ", ".join(f"'{z}'" for z in RESTRICTED_ZIP3)


def _age(start: str, end: str) -> str:
    early = f"strftime({end}, '%m%d') < strftime({start}, '%m%d')"
    return f"(year({end}) - year({start}) - CASE WHEN {early} THEN 1 ELSE 0 END)"


def _key(date: str) -> str:
    return f"CAST(strftime({date}, '%Y%m%d') AS INTEGER)"


MONEY = "DECIMAL(18,2)"

TABLES: dict[str, str] = {}

TABLES["stg_patients"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS patient_id,
  CASE WHEN c_custkey % 997 <> 13
    THEN DATE '1905-01-01' + CAST(c_custkey * 7919 % 32000 AS INTEGER) END AS birth_date,
  CASE WHEN c_custkey % 211 = 5
      THEN DATE '1905-01-01' + CAST(c_custkey * 7919 % 32000 - 30 AS INTEGER)
    WHEN c_custkey % 7 = 0
      THEN DATE '1999-01-01' + CAST(c_custkey * 31 % 900 AS INTEGER) END AS death_date,
  CASE WHEN c_custkey % 2 = 0 THEN 'Mr.' ELSE 'Ms.' END AS name_prefix,
  'First' || c_custkey AS first_name, c_name AS last_name,
  CAST(NULL AS VARCHAR) AS name_suffix,
  CASE WHEN c_custkey % 4 = 1 THEN 'Maiden' || c_custkey END AS maiden_name,
  CASE WHEN c_custkey % 457 = 11 THEN 'D' WHEN c_custkey % 3 = 0 THEN 'M'
    WHEN c_custkey % 3 = 1 THEN 'S' END AS marital_status,
  ['white', 'black', 'asian', 'hawaiian', 'native', 'other'][c_custkey % 6 + 1] AS race,
  CASE WHEN c_custkey % 5 = 0 THEN 'hispanic' ELSE 'nonhispanic' END AS ethnicity,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  'Nation ' || c_nationkey AS birthplace,
  c_custkey || ' Main Street' AS street_address, 'City ' || (c_custkey % 50) AS city,
  'MA' AS state, 'County ' || (c_custkey % 14) AS county,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 499 = 7 THEN '1A309'
    ELSE lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') END AS zip_code,
  CAST('42.' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS latitude,
  CAST('-71.' || lpad(CAST(c_custkey * 3 % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS longitude,
  CAST(c_acctbal AS {MONEY}) AS healthcare_expenses,
  CAST(floor(c_acctbal) AS {MONEY}) AS healthcare_coverage
FROM customer"""

TABLES["order_moments"] = """
SELECT *, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS started_at,
  CASE WHEN o_orderkey % 1009 = 17 THEN -60
    WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 997 = 0 THEN 35000000
    WHEN o_orderpriority = '1-URGENT' THEN 43200 + o_orderkey * 613 % 400000
    ELSE 600 + o_orderkey * 613 % 7200 END AS stay_seconds,
  CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_orderkey % 23 END AS code,
  CASE WHEN o_orderkey % 1601 = 11 THEN '99' WHEN o_orderkey % 1709 = 13 THEN NULL
    WHEN o_orderkey % 3 = 0 THEN '9' ELSE CAST(o_orderkey % 25 AS VARCHAR) END AS payer
FROM orders"""

TABLES["stg_encounters"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
  CASE WHEN o_orderkey % 1511 = 9 THEN 'missing-' || o_custkey
    ELSE CAST(o_custkey AS VARCHAR) END AS patient_id,
  CAST(o_custkey // 15 AS VARCHAR) AS organization_id,
  CAST(o_custkey // 15 * 20 + o_custkey % 15 AS VARCHAR) AS provider_id,
  payer AS payer_id, started_at, started_at + to_seconds(stay_seconds) AS stopped_at,
  CASE WHEN o_orderkey % 1201 = 3 THEN NULL WHEN o_orderkey % 1301 = 5 THEN 'virtual'
    ELSE ['inpatient', 'emergency', 'outpatient', 'ambulatory', 'wellness'][
      CAST(left(o_orderpriority, 1) AS INTEGER)] END AS encounter_class,
  CAST(code AS VARCHAR) AS encounter_code,
  (CASE WHEN code % 4 = 3 AND o_orderkey % 10 < 3 THEN 'ENCOUNTER TYPE '
    ELSE 'Encounter type ' END) || code AS encounter_description,
  CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 1801 = 15
    THEN 'R' || (o_orderkey % 40) END AS reason_code,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Reason ' || (o_orderkey % 40) END AS reason_description,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN 129.16 ELSE 77.49 END AS {MONEY})
    AS base_encounter_cost,
  CAST(o_totalprice AS {MONEY}) AS total_claim_cost,
  CAST(CASE WHEN o_orderkey % 1901 = 21 THEN floor(o_totalprice) + 100
    WHEN payer = '9' THEN 0 ELSE floor(o_totalprice * 0.6) END AS {MONEY}) AS payer_coverage
FROM order_moments"""

TABLES["order_lines"] = """
SELECT lineitem.*, o_custkey, CAST(o_orderdate AS DATE) AS order_day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

TABLES["stg_conditions"] = """
SELECT CASE WHEN (l_orderkey + l_linenumber) % 2003 = 1 THEN CAST(o_custkey + 1 AS VARCHAR)
    WHEN (l_orderkey + l_linenumber) % 2017 = 5 THEN 'missing-' || o_custkey
    ELSE CAST(o_custkey AS VARCHAR) END AS patient_id,
  CAST(l_orderkey AS VARCHAR) AS encounter_id, onset AS started_date,
  CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_partkey % 2011 = 2 THEN onset - 1
    ELSE onset + CAST(l_quantity AS INTEGER) * 11 END AS stopped_date,
  CAST(code AS VARCHAR) AS condition_code,
  (CASE WHEN l_partkey % 40 = 0 AND l_linenumber <= 2 THEN 'CONDITION ' ELSE 'Condition ' END)
    || code || [' (finding)', ' (disorder)', ''][code % 3 + 1] AS condition_description
FROM (SELECT *,
    order_day + CAST(l_orderkey * l_linenumber * 13 % 41 - 8 AS INTEGER) AS onset,
    CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 0 ELSE l_partkey % 200 END AS code
  FROM order_lines)"""

TABLES["stg_organizations"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS organization_id,
  '  ' || s_name || '  ' || chr(9) || ' Hospital ' AS organization_name,
  s_suppkey || ' Care Road' AS street_address, 'City ' || s_nationkey AS city,
  CASE WHEN s_suppkey % 41 = 3 THEN 'NH' ELSE 'MA' END AS state,
  lpad(CAST(s_suppkey * 53 % 100000 AS VARCHAR), 5, '0') AS zip_code,
  CAST('42.' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS latitude,
  CAST('-71.' || lpad(CAST(s_suppkey * 7 % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS longitude,
  '555-' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') AS phone,
  CAST(s_acctbal AS {MONEY}) AS revenue, CAST(s_suppkey * 41 % 1000 AS INTEGER) AS utilization
FROM supplier"""

TABLES["stg_providers"] = """
SELECT CAST(p_partkey AS VARCHAR) AS provider_id,
  CASE WHEN p_partkey % 503 = 4 THEN 'gone-' || p_partkey
    ELSE CAST(p_partkey // 20 AS VARCHAR) END AS organization_id,
  p_name || ' ' || p_partkey AS provider_name,
  CASE WHEN p_partkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN p_partkey % 3 = 0 THEN 'GENERAL PRACTICE' ELSE p_type END AS specialty,
  (p_partkey // 20) || ' Care Road' AS street_address, 'City ' || (p_partkey % 50) AS city,
  'MA' AS state, lpad(CAST(p_partkey * 53 % 100000 AS VARCHAR), 5, '0') AS zip_code,
  CAST('42.' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS latitude,
  CAST('-71.' || lpad(CAST(p_partkey * 7 % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS longitude,
  CAST(p_size AS INTEGER) AS utilization
FROM part"""

TABLES["stg_payers"] = f"""
SELECT CAST(n_nationkey AS VARCHAR) AS payer_id,
  CASE n_nationkey WHEN 6 THEN 'Medicare' WHEN 7 THEN 'Medicaid' WHEN 8 THEN 'Dual Eligible'
    WHEN 9 THEN 'NO_INSURANCE' ELSE any_value(n_name) END AS payer_name,
  CASE WHEN n_nationkey <> 9 THEN n_nationkey || ' Plan Street' END AS street_address,
  CASE WHEN n_nationkey <> 9 THEN 'City ' || n_nationkey END AS city,
  CASE WHEN n_nationkey <> 9 THEN 'S' || any_value(n_regionkey) END AS headquarters_state,
  CASE WHEN n_nationkey <> 9
    THEN lpad(CAST(n_nationkey * 53 AS VARCHAR), 5, '0') END AS zip_code,
  CASE WHEN n_nationkey <> 9
    THEN '555-' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') END AS phone,
  CAST(coalesce(sum(balance) FILTER (balance > 0), 0) AS {MONEY}) AS amount_covered,
  CAST(coalesce(sum(-balance) FILTER (balance < 0), 0) AS {MONEY}) AS amount_uncovered,
  CAST(coalesce(sum(balance), 0) AS {MONEY}) AS revenue,
  CAST(count(*) FILTER (balance >= 0) AS INTEGER) AS covered_encounters,
  CAST(count(*) FILTER (balance < 0) AS INTEGER) AS uncovered_encounters,
  CAST(count(*) FILTER (c_mktsegment = 'BUILDING') AS INTEGER) AS covered_medications,
  CAST(count(*) FILTER (c_mktsegment = 'MACHINERY') AS INTEGER) AS uncovered_medications,
  covered_medications AS covered_procedures, uncovered_medications AS uncovered_procedures,
  covered_medications AS covered_immunizations,
  uncovered_medications AS uncovered_immunizations,
  CAST(count(c_custkey) AS INTEGER) AS unique_customers,
  CAST(count(c_custkey) AS INTEGER) AS member_months,
  CAST('0.' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS DOUBLE)
    AS quality_of_life_score_avg
FROM nation LEFT JOIN (SELECT *, CAST(c_acctbal AS {MONEY}) AS balance FROM customer)
  ON n_nationkey = c_nationkey
GROUP BY n_nationkey"""

TABLES["feed_claims"] = """
SELECT l_orderkey || '-' || l_linenumber AS claim_id, CAST(o_custkey AS VARCHAR) AS patient,
  CAST(l_partkey AS VARCHAR) AS provider, CAST(NULL AS VARCHAR) AS referring,
  CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_partkey * 2 AS VARCHAR) END AS supervising,
  CASE WHEN l_orderkey % 101 = 0 THEN 'x' || l_orderkey
    WHEN l_orderkey % 50 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS encounter,
  CASE WHEN l_orderkey % 3 = 0 THEN '0' ELSE '7' END AS insurance,
  CASE WHEN l_linenumber = 3 AND l_orderkey % 11 = 0 THEN '2' ELSE '1' END AS type1,
  CASE WHEN l_linenumber % 2 = 1 THEN '0' END AS type2
FROM order_lines"""

TABLES["feed_transactions"] = f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
    || CAST(l_shipdate AS DATE) AS transaction_id,
  CASE WHEN l_suppkey % 10 = 3 THEN 'gone-' || l_orderkey
    ELSE l_orderkey || '-' || l_linenumber END AS claim_id,
  CAST(o_custkey AS VARCHAR) AS patient, CAST(l_partkey AS VARCHAR) AS provider,
  CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_suppkey AS VARCHAR) END AS supervising,
  CAST(l_orderkey AS VARCHAR) AS encounter,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL
    WHEN l_returnflag = 'A' THEN 'CHARGE' WHEN l_returnflag = 'N' THEN 'TRANSFERIN'
    WHEN l_linestatus = 'F' THEN 'PAYMENT' ELSE 'TRANSFEROUT' END AS kind,
  CAST(l_extendedprice AS {MONEY}) AS money
FROM order_lines"""

TABLES["feed_transitions"] = """
SELECT CASE WHEN event_id % 3 = 0 THEN '9' ELSE CAST(user_id % 25 AS VARCHAR) END AS payer,
  CASE WHEN event_type = 'purchase' THEN CAST(user_id * 3 % 26 AS VARCHAR) END AS second_payer
FROM events"""

TABLES["condition_spellings"] = """
SELECT condition_code AS code, condition_description AS label, count(*) AS uses
FROM stg_conditions GROUP BY ALL"""

TABLES["dim_condition"] = r"""
SELECT code AS condition_code, label AS condition_description,
  CASE WHEN regexp_matches(label, '\([^()]+\)$')
    THEN regexp_extract(label, '\(([^()]+)\)$', 1) END AS source_semantic_tag,
  source_spelling_count, condition_count, patient_count
FROM (SELECT code, list(label ORDER BY uses DESC, label)[1] AS label,
    count(*) AS source_spelling_count, CAST(sum(uses) AS BIGINT) AS condition_count
  FROM condition_spellings GROUP BY code)
JOIN (SELECT condition_code AS code, count(DISTINCT patient_id) AS patient_count
  FROM stg_conditions GROUP BY condition_code) USING (code)"""

TABLES["dim_encounter_type"] = """
SELECT code AS encounter_code, list(label ORDER BY uses DESC, label)[1] AS encounter_description,
  count(*) AS source_spelling_count, CAST(sum(uses) AS BIGINT) AS encounter_count
FROM (SELECT encounter_code AS code, encounter_description AS label, count(*) AS uses
  FROM stg_encounters GROUP BY ALL)
GROUP BY code"""

TABLES["dim_date"] = f"""
SELECT {_key('d')} AS date_id, d AS calendar_date, year(d) AS calendar_year,
  quarter(d) AS calendar_quarter, month(d) AS calendar_month, strftime(d, '%B') AS month_name,
  strftime(d, '%Y-%m') AS year_month, day(d) AS day_of_month,
  CAST(strftime(d, '%u') AS BIGINT) AS day_of_week, strftime(d, '%A') AS day_name,
  CAST(strftime(d, '%G') AS BIGINT) AS iso_year, CAST(strftime(d, '%V') AS BIGINT) AS iso_week,
  CAST(strftime(d, '%G%V') AS BIGINT) AS iso_year_week,
  strftime(d, '%u') IN ('6', '7') AS is_weekend
FROM (SELECT CAST(range AS DATE) AS d FROM range(
  (SELECT CAST(min(started_at) AS DATE) FROM stg_encounters),
  (SELECT CAST(max(started_at) AS DATE) FROM stg_encounters) + INTERVAL 1 DAY,
  INTERVAL 1 DAY))"""

TABLES["dim_organization"] = """
SELECT organization_id,
  array_to_string(list_filter(regexp_split_to_array(organization_name, '[ \t]+'),
    lambda w: w <> ''), ' ') AS organization_name,
  street_address, city, state, zip_code, latitude, longitude, phone,
  utilization AS source_reported_utilization
FROM stg_organizations"""

TABLES["dim_provider"] = """
SELECT provider_id, organization_id, provider_name, gender, specialty,
  utilization AS source_reported_utilization
FROM stg_providers"""

TABLES["dim_payer"] = """
SELECT payer_id, payer_name, financial AS payer_financial_class,
  CASE WHEN financial IN ('commercial', 'self_pay') THEN financial ELSE 'public' END
    AS payer_category,
  payer_name = 'NO_INSURANCE' AS is_self_pay, headquarters_state,
  amount_covered AS lifetime_amount_covered, amount_uncovered AS lifetime_amount_uncovered,
  revenue AS lifetime_revenue, covered_encounters AS lifetime_covered_encounters,
  uncovered_encounters AS lifetime_uncovered_encounters,
  unique_customers AS lifetime_unique_customers, member_months AS lifetime_member_months,
  quality_of_life_score_avg
FROM (SELECT *, CASE WHEN payer_name IN ('Medicare', 'Medicaid', 'Dual Eligible')
    THEN replace(lower(payer_name), ' ', '_')
    WHEN payer_name = 'NO_INSURANCE' THEN 'self_pay' ELSE 'commercial' END AS financial
  FROM stg_payers)"""

TABLES["published_dates"] = """
SELECT patient_id, published_date FROM (
  SELECT patient_id, death_date AS published_date FROM stg_patients
  UNION ALL SELECT patient_id, unnest([CAST(started_at AS DATE), CAST(stopped_at AS DATE)])
  FROM stg_encounters
  UNION ALL SELECT patient_id, unnest([started_date, stopped_date]) FROM stg_conditions)
WHERE published_date IS NOT NULL"""

TABLES["attained"] = f"""
SELECT p.*, {_age('birth_date', 'until')} AS attained_age FROM (
  SELECT p.*, coalesce(seen.latest, all_seen.latest) AS until FROM stg_patients p
  LEFT JOIN (SELECT patient_id, max(published_date) AS latest FROM published_dates GROUP BY 1) seen
    ON seen.patient_id = p.patient_id
  CROSS JOIN (SELECT max(published_date) AS latest FROM published_dates) all_seen) p"""

TABLES["dim_patient"] = f"""
SELECT patient_id,
  CASE WHEN attained_age < 90 THEN year(birth_date) END AS birth_year,
  CASE WHEN attained_age < 90 THEN year(death_date) END AS death_year,
  death_date IS NOT NULL AS is_deceased, attained_age > 89 AS is_age_90_or_older,
  CASE WHEN {_age('birth_date', 'death_date')} > 90 THEN 90
    ELSE {_age('birth_date', 'death_date')} END AS age_at_death_years,
  gender, race, ethnicity, marital_status, state,
  CASE WHEN left(zip_code, 3) IN ({ZIPS}) THEN '000' ELSE left(zip_code, 3) END AS zip3,
  healthcare_expenses AS lifetime_healthcare_expenses,
  healthcare_coverage AS lifetime_healthcare_coverage
FROM attained"""

TABLES["protected_cohort"] = "SELECT patient_id FROM dim_patient WHERE is_age_90_or_older"

TABLES["fct_encounter"] = f"""
SELECT e.encounter_id, {_key('started_at')} AS date_id, e.patient_id, organization_id,
  provider_id, payer_id, encounter_code, encounter_class, reason_code, reason_description,
  started_at, stopped_at,
  CAST(epoch(date_trunc('second', stopped_at)) - epoch(date_trunc('second', started_at))
    AS BIGINT) // 60 AS duration_minutes,
  CASE WHEN encounter_class = 'inpatient'
    THEN CAST(stopped_at AS DATE) - CAST(started_at AS DATE) END AS length_of_stay_days,
  CASE WHEN e.patient_id NOT IN (SELECT patient_id FROM protected_cohort)
    THEN {_age('birth_date', 'started_at')} END AS patient_age_years,
  coalesce(n_conditions, 0) AS condition_count, base_encounter_cost, total_claim_cost,
  payer_coverage, total_claim_cost - payer_coverage AS uncovered_amount
FROM stg_encounters e JOIN stg_patients p USING (patient_id)
LEFT JOIN (SELECT encounter_id, count(*) AS n_conditions FROM stg_conditions GROUP BY 1) n
  ON n.encounter_id = e.encounter_id"""

TABLES["fct_condition"] = f"""
SELECT c.patient_id, c.encounter_id, condition_code, {_key('started_date')} AS start_date_id,
  {_key('stopped_date')} AS stop_date_id, started_date, stopped_date,
  stopped_date - started_date AS duration_days, stopped_date IS NULL AS is_open,
  started_date - CAST(started_at AS DATE) AS days_from_encounter_start,
  CASE WHEN c.patient_id NOT IN (SELECT patient_id FROM protected_cohort)
    THEN {_age('birth_date', 'started_date')} END AS patient_age_years
FROM stg_conditions c JOIN stg_patients p ON p.patient_id = c.patient_id
JOIN stg_encounters e ON e.encounter_id = c.encounter_id"""

# Tables whose privacy rules are off.
TABLES["open_patient"] = f"""
SELECT d.patient_id, year(birth_date) AS birth_year, year(death_date) AS death_year,
  is_age_90_or_older, {_age('birth_date', 'death_date')} AS age_at_death_years,
  left(zip_code, 3) AS zip3
FROM dim_patient d JOIN stg_patients s ON s.patient_id = d.patient_id"""
TABLES["open_encounter"] = f"""
SELECT f.* REPLACE ({_age('birth_date', 'started_at')} AS patient_age_years)
FROM fct_encounter f JOIN stg_patients s ON s.patient_id = f.patient_id"""
TABLES["open_condition"] = f"""
SELECT f.* REPLACE ({_age('birth_date', 'started_date')} AS patient_age_years)
FROM fct_condition f JOIN stg_patients s ON s.patient_id = f.patient_id"""


# Tables that one statement reads in several places.
READ_OFTEN = {
    "stg_patients", "stg_encounters", "stg_conditions", "published_dates", "attained",
    "dim_patient", "protected_cohort", "fct_encounter", "fct_condition",
    "open_patient", "open_encounter", "open_condition",
}


def with_tables(select: str) -> str:
    """The statement with the tables it names, and theirs, as a WITH prefix."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(select)
    parts = [
        f"{name} AS {'MATERIALIZED ' if name in READ_OFTEN else ''}(\n{body}\n)"
        for name, body in TABLES.items()
        if name in needed
    ]
    return f"WITH {', '.join(parts)}\n{select}" if parts else select


def _checks(patient: str, encounter: str, condition: str) -> dict[str, str]:
    grain = "patient_id, encounter_id, condition_code"

    def repeated(table: str) -> str:
        return (
            f"SELECT {grain}, count(*) AS rows_in_group FROM {table} "
            "GROUP BY ALL HAVING rows_in_group > 1"
        )

    def difference(left: str, right: str, keys: str, label: str) -> str:
        same = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
        return (
            f"SELECT {keys}, '{label}' AS problem FROM {left} a "
            f"WHERE NOT EXISTS (SELECT 1 FROM {right} b WHERE {same})"
        )

    def both(staged: str, fact: str, keys: str) -> str:
        return (
            difference(staged, fact, keys, "missing from fact")
            + " UNION ALL "
            + difference(fact, staged, keys, "not in staging")
        )

    dates = f"""(SELECT patient_id, unnest([CAST(started_at AS DATE), CAST(stopped_at AS DATE)])
        AS published_date FROM {encounter}
      UNION ALL SELECT patient_id, unnest([started_date, stopped_date]) FROM {condition})"""
    return {
        "condition_grain_is_unique": repeated("stg_conditions"),
        "condition_fact_grain_is_unique": repeated(condition),
        "condition_fact_matches_staging_grain": both("stg_conditions", condition, grain),
        "encounter_fact_matches_staging_grain": both(
            "stg_encounters", encounter, "encounter_id"
        ),
        "condition_patient_matches_encounter_patient": f"""
SELECT encounter_id, condition_code, c.patient_id AS condition_patient_id,
  e.patient_id AS encounter_patient_id
FROM {condition} c JOIN {encounter} e USING (encounter_id) WHERE c.patient_id <> e.patient_id""",
        "condition_stop_not_before_start": f"""
SELECT {grain}, started_date, stopped_date FROM stg_conditions
WHERE started_date > stopped_date""",
        "encounter_stop_not_before_start": """
SELECT encounter_id, started_at, stopped_at FROM stg_encounters WHERE started_at > stopped_at""",
        "patient_death_not_before_birth": """
SELECT patient_id, birth_date, death_date FROM stg_patients WHERE birth_date > death_date""",
        "encounter_payer_coverage_within_claim_cost": """
SELECT encounter_id, total_claim_cost, payer_coverage FROM stg_encounters
WHERE total_claim_cost < payer_coverage""",
        "uncovered_amount_not_negative": f"""
SELECT encounter_id, total_claim_cost, payer_coverage, uncovered_amount FROM {encounter}
WHERE total_claim_cost < payer_coverage""",
        "encounter_reason_is_coded_and_labeled": """
SELECT encounter_id, reason_code, reason_description FROM stg_encounters
WHERE (reason_code IS NULL AND reason_description IS NOT NULL)
  OR (reason_code IS NOT NULL AND reason_description IS NULL)""",
        "length_of_stay_is_inpatient_only": f"""
SELECT encounter_id, encounter_class, length_of_stay_days FROM {encounter}
WHERE encounter_class IS NULL
  OR (encounter_class = 'inpatient') <> (length_of_stay_days IS NOT NULL)""",
        "inpatient_length_of_stay_is_plausible": f"""
SELECT encounter_id, patient_id, started_at, stopped_at, length_of_stay_days FROM {encounter}
WHERE length_of_stay_days >= 0
  AND CAST(stopped_at AS DATE) > CAST(started_at AS DATE) + INTERVAL 12 MONTH""",
        "encounter_start_not_after_patient_death": f"""
SELECT encounter_id, patient_id, CAST(started_at AS DATE) AS encounter_date, death_date,
  CAST(started_at AS DATE) - death_date AS days_after_death
FROM {encounter} JOIN stg_patients USING (patient_id) WHERE days_after_death > 0""",
        "patient_zip3_is_a_permitted_prefix": f"""
SELECT patient_id, zip3, unnest(list_filter([
  CASE WHEN NOT regexp_full_match(zip3, '[0-9][0-9][0-9]')
    THEN 'not a three-digit prefix' END,
  CASE WHEN list_contains([{ZIPS}], zip3) THEN 'restricted prefix published' END],
  lambda v: v IS NOT NULL)) AS violation FROM {patient}""",
        "safe_harbor_age_over_89_is_suppressed": f"""
SELECT patient_id, 'year element retained for an over-89 patient' AS violation FROM {patient}
WHERE is_age_90_or_older AND coalesce(birth_year, death_year) IS NOT NULL
UNION ALL SELECT patient_id, 'age_at_death_years above the aggregated category' FROM {patient}
WHERE age_at_death_years >= 91
UNION ALL SELECT patient_id, 'patient_age_years over 89 on the encounter fact' FROM {encounter}
WHERE patient_age_years >= 90
UNION ALL SELECT patient_id, 'patient_age_years over 89 on the condition fact' FROM {condition}
WHERE patient_age_years >= 90
UNION ALL SELECT patient_id, 'a published date puts this patient over 89' FROM (
  SELECT * FROM {dates} UNION ALL SELECT patient_id, death_date FROM stg_patients)
JOIN stg_patients s USING (patient_id) JOIN {patient} d USING (patient_id)
WHERE d.birth_year IS NOT NULL AND {_age('s.birth_date', 'published_date')} >= 90""",
        # Dates as numbers YYYYMMDD; the bound's 29 February is the 28th in a common year.
        "fact_age_and_date_do_not_imply_over_89": f"""
SELECT patient_id, anchor_age, anchor_date, latest_date, implied_age FROM (
  WITH rows AS MATERIALIZED (
    SELECT patient_id, patient_age_years AS anchor_age, CAST(started_at AS DATE) AS anchor_date,
      CAST(stopped_at AS DATE) AS other_date FROM {encounter}
    UNION ALL SELECT patient_id, patient_age_years, started_date, stopped_date FROM {condition}
  ), latest AS MATERIALIZED (
    SELECT patient_id, max(greatest(anchor_date, other_date)) AS latest_date FROM rows GROUP BY 1
  ), bounds AS MATERIALIZED (
    SELECT patient_id, anchor_age, anchor_date, year(anchor_date) - anchor_age AS y,
      month(anchor_date) * 100 + day(anchor_date) AS md
    FROM rows WHERE anchor_age IS NOT NULL
  ), keyed AS MATERIALIZED (
    SELECT patient_id, anchor_age, anchor_date, y * 10000 + md
      - CASE WHEN md = 229 AND (y % 4 <> 0 OR (y % 100 = 0 AND y % 400 <> 0)) THEN 1 ELSE 0 END
      AS born FROM bounds
  ), aged AS MATERIALIZED (
    SELECT k.*, latest_date,
      (year(latest_date) * 10000 + month(latest_date) * 100 + day(latest_date) - born) // 10000
        AS implied_age
    FROM keyed k JOIN latest l ON l.patient_id = k.patient_id
  )
  SELECT * FROM aged WHERE implied_age >= 90)""",
        "fact_age_is_withheld_for_the_protected_cohort": f"""
SELECT * FROM (
  SELECT 'fct_encounter' AS fact, encounter_id AS row_key, patient_id, patient_age_years
  FROM {encounter}
  UNION ALL SELECT 'fct_condition', patient_id || '|' || condition_code, patient_id,
    patient_age_years FROM {condition})
WHERE (patient_id IN (SELECT patient_id FROM protected_cohort))
  <> (patient_age_years IS NULL)""",
    }


# Raw feeds hold the keys of their staging tables under other names.
_FEED_KEYS = {
    ("feed_conditions", "PATIENT"): ("stg_conditions", "patient_id"),
    ("feed_conditions", "ENCOUNTER"): ("stg_conditions", "encounter_id"),
    ("feed_encounters", "Id"): ("stg_encounters", "encounter_id"),
    ("feed_organizations", "Id"): ("stg_organizations", "organization_id"),
    ("feed_patients", "Id"): ("stg_patients", "patient_id"),
    ("feed_payers", "Id"): ("stg_payers", "payer_id"),
    ("feed_providers", "Id"): ("stg_providers", "provider_id"),
}


def _generic() -> dict[str, str]:
    def row(table: str, column: str, rule: str, count: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    def source(table: str, column: str) -> tuple[str, str]:
        return _FEED_KEYS.get((table, column), (table, column))

    not_null, unique, relationships, accepted = [], [], [], []
    for table, columns in rule_map.NOT_NULL.items():
        for column in columns:
            t, c = source(table, column)
            count = f"SELECT count(*) - count({c}) FROM {t}"
            not_null.append(row(table, column, "not_null", count))
    for table, columns in rule_map.UNIQUE.items():
        for column in columns:
            t, c = source(table, column)
            count = (
                f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1)"
            )
            unique.append(row(table, column, "unique", count))
    for child, key, parent, parent_key in rule_map.RELATIONSHIPS:
        count = (
            f"SELECT count(*) FROM {child} c WHERE {key} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})"
        )
        relationships.append(row(child, key, "relationships", count))
    for table, columns in rule_map.ACCEPTED_VALUES.items():
        for column, values in columns.items():
            listed = ", ".join(repr(v) for v in values)
            count = (
                f"SELECT count(DISTINCT {column}) FROM {table} "
                f"WHERE NOT list_contains([{listed}], {column})"
            )
            accepted.append(row(table, column, "accepted_values", count))
    return {
        "dq_not_null": " UNION ALL ".join(not_null),
        "dq_unique": " UNION ALL ".join(unique),
        "dq_relationships": " UNION ALL ".join(relationships),
        "dq_accepted_values": " UNION ALL ".join(accepted),
    }


def _summary(
    generic: dict[str, str], checks: dict[str, str], thresholds: dict[str, tuple[int, int]]
) -> str:
    counts = [
        f"SELECT concat_ws('.', rule, table_name, column_name) AS rule, violations FROM ({q})"
        for q in generic.values()
    ]
    counts += [
        f"SELECT '{name}' AS rule, count(*) AS violations FROM ({q})"
        for name, q in checks.items()
    ]
    counts.append(
        "SELECT 'patient_dimension_excludes_name_place_and_date_columns' AS rule, "
        "CAST(0 AS BIGINT) AS violations"
    )
    limits = ", ".join(f"('{n}', {w}, {e})" for n, (w, e) in thresholds.items())
    return f"""
SELECT rule, violations, CAST(coalesce(w, 0) AS BIGINT) AS warn_if,
  CAST(coalesce(e, 0) AS BIGINT) AS error_if,
  CASE WHEN violations > coalesce(e, 0) THEN 'error'
    WHEN violations > coalesce(w, 0) THEN 'warn' ELSE 'pass' END AS status
FROM ({' UNION ALL '.join(counts)}) LEFT JOIN (VALUES {limits}) t(rule, w, e) USING (rule)"""


def _claim_figures() -> str:
    null = "CAST(NULL AS BIGINT)"
    no_money = "CAST(NULL AS DECIMAL(38,2))"

    def figure(sort: int, text: str, n: str, of_n: str = null, amount: str = no_money) -> str:
        return (
            f"SELECT {sort} AS sort, '{text}' AS figure, CAST(({n}) AS BIGINT) AS n, "
            f"CAST(({of_n}) AS BIGINT) AS of_n, CAST(({amount}) AS DECIMAL(38,2)) AS amount"
        )

    def count(table: str, condition: str = "TRUE", what: str = "*") -> str:
        return f"SELECT count({what}) FROM {table} WHERE {condition}"

    def lost(sort: int, plural: str, name: str, table: str, key: str, parent: str, pk: str) -> str:
        unresolved = f"{key} IS NOT NULL AND {key} NOT IN (SELECT {pk} FROM {parent})"
        suffix = " to an encounter" if parent == "stg_encounters" else ""
        text = f"{plural} whose {name} does not resolve{suffix}"
        return figure(sort, text, count(table, unresolved), count(table, f"{key} IS NOT NULL"))

    claims, moves = "feed_claims", "feed_transactions"
    persons = ("stg_patients", "patient_id")
    providers = ("stg_providers", "provider_id")
    encounters = ("stg_encounters", "encounter_id")
    parts = [
        figure(1, "claims", count(claims)),
        figure(
            2, "claims with a distinct Id", count(claims, what="DISTINCT claim_id"), count(claims)
        ),
        figure(3, "claims with a null Id", count(claims, "claim_id IS NULL"), count(claims)),
        figure(4, "claim transactions", count(moves)),
        figure(
            5,
            "claim transactions with a distinct ID",
            count(moves, what="DISTINCT transaction_id"),
            count(moves),
        ),
        figure(
            6,
            "claim transactions with a null ID",
            count(moves, "transaction_id IS NULL"),
            count(moves),
        ),
        lost(7, "claims", "PATIENTID", claims, "patient", *persons),
        lost(8, "claims", "PROVIDERID", claims, "provider", *providers),
        lost(9, "claims", "REFERRINGPROVIDERID", claims, "referring", *providers),
        lost(10, "claims", "SUPERVISINGPROVIDERID", claims, "supervising", *providers),
        lost(11, "claims", "APPOINTMENTID", claims, "encounter", *encounters),
        lost(12, "claim transactions", "PATIENTID", moves, "patient", *persons),
        lost(13, "claim transactions", "PROVIDERID", moves, "provider", *providers),
        lost(14, "claim transactions", "SUPERVISINGPROVIDERID", moves, "supervising", *providers),
        lost(15, "claim transactions", "APPOINTMENTID", moves, "encounter", *encounters),
        lost(16, "claim transactions", "CLAIMID", moves, "claim_id", claims, "claim_id"),
    ]
    per = """(SELECT e.encounter_id, count(c.encounter) AS n,
        count(DISTINCT CASE WHEN c.encounter IS NOT NULL THEN coalesce(type1, '(null)') END) AS t1,
        count(DISTINCT CASE WHEN c.encounter IS NOT NULL THEN coalesce(type2, '(null)') END) AS t2
      FROM (SELECT DISTINCT encounter_id FROM stg_encounters) e
      LEFT JOIN feed_claims c ON c.encounter = e.encounter_id GROUP BY 1)"""
    for sort, text, condition in (
        (17, "encounters with no claim", "n = 0"),
        (18, "encounters with exactly one claim", "n = 1"),
        (20, "encounters whose claims carry more than one HEALTHCARECLAIMTYPEID1", "t1 > 1"),
        (21, "encounters whose claims carry more than one HEALTHCARECLAIMTYPEID2", "t2 > 1"),
    ):
        parts.append(figure(sort, text, count(per, condition), count(per)))
    parts.append(figure(19, "most claims on one encounter", f"SELECT max(n) FROM {per}"))
    parts.append(
        f"SELECT 22, 'claim transactions typed ' || coalesce(kind, '(null)'), count(*), "
        f"({count(moves)}), {no_money} FROM {moves} GROUP BY kind"
    )
    for sort, kind, text, filled in (
        (23, "PAYMENT", "an AMOUNT", "FALSE"),
        (24, "PAYMENT", "PAYMENTS", "money IS NOT NULL"),
        (25, "TRANSFEROUT", "an AMOUNT", "FALSE"),
        (26, "TRANSFEROUT", "TRANSFERS", "money IS NOT NULL"),
    ):
        mine = f"kind = '{kind}'"
        parts.append(
            figure(
                sort,
                f"{kind} transactions with {text}",
                count(moves, f"{mine} AND {filled}"),
                count(moves, mine),
            )
        )
    parts.append(
        figure(
            27,
            "claims whose PRIMARYPATIENTINSURANCEID is the self-pay sentinel 0",
            count(claims, "insurance = '0'"),
            count(claims),
        )
    )
    unpaid = "payer_id IS NULL OR payer_id NOT IN (SELECT payer_id FROM stg_payers)"
    parts.append(
        figure(
            28,
            "encounters whose PAYER is missing or does not resolve",
            count("stg_encounters", unpaid),
            count("stg_encounters"),
        )
    )
    parts.append(
        figure(
            29,
            "CHARGE transactions, AMOUNT summed",
            count(moves, "kind = 'CHARGE'"),
            null,
            f"SELECT sum(money) FROM {moves} WHERE kind = 'CHARGE'",
        )
    )
    parts.append(
        figure(
            30,
            "encounters, TOTAL_CLAIM_COST summed",
            count("stg_encounters"),
            null,
            "SELECT sum(total_claim_cost) FROM stg_encounters",
        )
    )
    return (
        "SELECT figure, n, of_n, amount FROM ("
        + " UNION ALL ".join(parts)
        + ") ORDER BY sort, figure"
    )


TABLES["spans"] = """
SELECT second_payer, a.payer_financial_class AS one, b.payer_financial_class AS two
FROM feed_transitions LEFT JOIN dim_payer a ON a.payer_id = payer
LEFT JOIN dim_payer b ON b.payer_id = second_payer"""

TABLES["span_figures"] = """
SELECT 1 AS sort, 'coverage spans' AS figure, count(*) AS n, CAST(NULL AS BIGINT) AS of_n
FROM spans
UNION ALL SELECT 2, 'spans whose primary payer does not resolve', count(*) - count(one), count(*)
FROM spans
UNION ALL SELECT 3, 'spans whose secondary payer does not resolve',
  count(second_payer) - count(two), count(*) FROM spans
UNION ALL SELECT 4, 'spans with a secondary payer', count(second_payer), count(*) FROM spans
UNION ALL SELECT 5, 'spans with a secondary payer, ' || one || ' primary and ' || two
    || ' secondary', count(*), sum(count(*)) OVER ()
FROM spans WHERE second_payer IS NOT NULL GROUP BY one, two
UNION ALL SELECT 6, 'spans whose primary payer is dual eligible',
  count(*) FILTER (one = 'dual_eligible'), count(*) FROM spans
UNION ALL SELECT 7, 'dual eligible spans with a secondary payer', count(second_payer), count(*)
FROM spans WHERE one = 'dual_eligible'"""

_SPANS = "SELECT figure, n, CAST(of_n AS BIGINT) AS of_n FROM span_figures ORDER BY sort, figure"


def _reports() -> dict[str, str]:
    wide = "DECIMAL(38,2)"

    def gap(directory: str, key: str, table: str) -> str:
        return f"""
SELECT '{directory}' AS directory, d.{key} AS member_id,
  CAST(any_value(source_reported_utilization) AS BIGINT) AS reported,
  count(f.{key}) AS counted, reported - counted AS gap
FROM {table} d LEFT JOIN fct_encounter f ON f.{key} = d.{key} GROUP BY d.{key}"""

    def total(name: str, on_fact: str, staged: str) -> str:
        return f"""
SELECT '{name}' AS measure, CAST(a AS {wide}) AS fact_total,
  CAST(b AS {wide}) AS staging_total, CAST(a - b AS {wide}) AS difference
FROM (SELECT (SELECT sum({on_fact}) FROM fct_encounter) AS a,
  (SELECT sum({staged}) FROM stg_encounters) AS b)"""

    ages = []
    for label, fact in (("encounters", "fct_encounter"), ("conditions", "fct_condition")):
        ages += [
            f"SELECT '{label} with an age', count(patient_age_years) FROM {fact}",
            f"SELECT '{label} with the age withheld', count(*) - count(patient_age_years) "
            f"FROM {fact}",
            f"SELECT 'highest age on {label}', max(patient_age_years) FROM {fact}",
        ]
    return {
        "report_payer_mix": f"""
SELECT payer_category, payer_financial_class, count(*) AS encounters,
  CAST(sum(total_claim_cost) AS {wide}) AS billed, CAST(sum(payer_coverage) AS {wide}) AS covered,
  CAST(sum(uncovered_amount) AS {wide}) AS uncovered
FROM fct_encounter LEFT JOIN dim_payer USING (payer_id) GROUP BY ALL""",
        "report_money": " UNION ALL ".join(
            [
                total("billed", "total_claim_cost", "total_claim_cost"),
                total("covered", "payer_coverage", "payer_coverage"),
                total("uncovered", "uncovered_amount", "total_claim_cost - payer_coverage"),
            ]
        ),
        "report_class_mix": """
SELECT encounter_class, count(*) AS encounters FROM fct_encounter GROUP BY ALL""",
        "report_condition_tags": """
SELECT source_semantic_tag, count(DISTINCT condition_code) AS codes, count(*) AS conditions
FROM fct_condition LEFT JOIN dim_condition USING (condition_code) GROUP BY ALL""",
        "report_top_conditions": """
SELECT condition_code, condition_description, count(*) AS conditions
FROM fct_condition LEFT JOIN dim_condition USING (condition_code) GROUP BY ALL
ORDER BY conditions DESC, condition_code LIMIT 10""",
        "report_drill_across": """
SELECT year_month, count(*) FILTER (kind = 'e') AS encounters,
  count(*) FILTER (kind = 'c') AS conditions
FROM (SELECT date_id, 'e' AS kind FROM fct_encounter
  UNION ALL SELECT start_date_id, 'c' FROM fct_condition)
LEFT JOIN dim_date USING (date_id) GROUP BY ALL""",
        "report_drill_across_patients": """
SELECT race, count(*) FILTER (kind = 'e') AS encounters,
  count(*) FILTER (kind = 'c') AS conditions
FROM (SELECT patient_id, 'e' AS kind FROM fct_encounter
  UNION ALL SELECT patient_id, 'c' FROM fct_condition)
LEFT JOIN dim_patient USING (patient_id) GROUP BY ALL""",
        "report_iso_week": f"""
SELECT iso_year_week, count(*) AS encounters, CAST(sum(total_claim_cost) AS {wide}) AS billed
FROM fct_encounter LEFT JOIN dim_date USING (date_id) GROUP BY ALL""",
        "report_utilization_gap": gap("organization", "organization_id", "dim_organization")
        + " UNION ALL "
        + gap("provider", "provider_id", "dim_provider"),
        "report_code_ambiguity": """
SELECT encounter_code, encounter_description, source_spelling_count,
  count(DISTINCT encounter_class) AS class_count
FROM fct_encounter LEFT JOIN dim_encounter_type USING (encounter_code) GROUP BY ALL
HAVING class_count > 1 OR source_spelling_count > 1""",
        "report_provider_coverage": """
SELECT specialty, count(*) AS providers,
  count(*) FILTER (provider_id IN (SELECT provider_id FROM fct_encounter))
    AS referenced_providers
FROM dim_provider GROUP BY ALL""",
        "report_suppression": """
SELECT 'patients' AS figure, count(*) AS n FROM dim_patient
UNION ALL SELECT 'protected patients', count(*) FROM protected_cohort
UNION ALL """
        + " UNION ALL ".join(ages),
        "report_residual_span": f"""
SELECT count(*) AS protected_patients, count(*) FILTER (years >= 90) AS spanning_over_89,
  max(years) AS longest_span_years
FROM (SELECT patient_id, {_age('low', 'high')} AS years FROM protected_cohort LEFT JOIN (
    SELECT patient_id, min(d) AS low, max(d) AS high FROM (
      SELECT patient_id, unnest([CAST(started_at AS DATE), CAST(stopped_at AS DATE)]) AS d
      FROM fct_encounter
      UNION ALL SELECT patient_id, unnest([started_date, stopped_date]) FROM fct_condition)
    GROUP BY 1) USING (patient_id))""",
    }


def _table_profiles() -> dict[str, str]:
    keys = [
        ("customer", "c_custkey"),
        ("orders", "o_orderkey"),
        ("orders", "o_custkey"),
        ("lineitem", "l_orderkey"),
        ("events", "user_id"),
        ("documents", "source"),
    ]
    references = [
        ("order", "l_orderkey", "orders", "o_orderkey"),
        ("part", "l_partkey", "part", "p_partkey"),
        ("supplier", "l_suppkey", "supplier", "s_suppkey"),
        ("part as supplier", "l_partkey", "supplier", "s_suppkey"),
    ]
    per_order = """
SELECT o_orderkey AS parent, count(l_orderkey) AS n_children,
  count(DISTINCT l_returnflag) > 1 AS l_returnflag_mixes,
  count(DISTINCT l_linestatus) > 1 AS l_linestatus_mixes
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"""
    price = f"CAST(l_extendedprice AS {MONEY})"
    return {
        "profile_keys": " UNION ALL ".join(
            f"SELECT '{t}.{k}' AS key_column, count(*) AS n_rows, count(DISTINCT {k}) "
            f"AS n_distinct, count(*) - count({k}) AS n_null FROM {t}"
            for t, k in keys
        ),
        "profile_references": " UNION ALL ".join(
            f"SELECT '{name}' AS reference, count({k}) AS n_set, count(*) FILTER "
            f"({k} NOT IN (SELECT {pk} FROM {parent})) AS n_unresolved FROM lineitem"
            for name, k, parent, pk in references
        ),
        "profile_children_per_parent": per_order,
        "profile_category_mixing": f"""
SELECT count(*) AS n_parents, count(*) FILTER (n_children = 0) AS n_without,
  count(*) FILTER (n_children = 1) AS n_with_one, max(n_children) AS most_children,
  count(*) FILTER (l_returnflag_mixes) AS n_l_returnflag_mixes,
  count(*) FILTER (l_linestatus_mixes) AS n_l_linestatus_mixes
FROM ({per_order})""",
        "profile_population": f"""
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (l_linestatus = 'F') AS with_finished,
  count(*) FILTER (l_tax <> 0) AS with_taxed,
  CAST(sum({price}) AS DECIMAL(38,2)) AS amount_total
FROM lineitem GROUP BY ALL""",
        "profile_reconciliation": f"""
SELECT 'money' AS measure, CAST(a AS DECIMAL(38,2)) AS orders_total,
  CAST(b AS DECIMAL(38,2)) AS lines_total, CAST(a - b AS DECIMAL(38,2)) AS difference
FROM (SELECT (SELECT sum(CAST(o_totalprice AS {MONEY})) FROM orders) AS a,
  (SELECT sum({price}) FROM lineitem) AS b)""",
    }


def _landed() -> dict[str, str]:
    """Each feed with one text column full of quotes, commas and line breaks."""

    def awkward(column: str) -> str:
        return f"""'"' || {column} || ', "quoted",' || chr(10) || 'line two, ' || {column} || '"" '"""

    staged = {
        "conditions": "condition_description",
        "encounters": "reason_description",
        "organizations": "organization_name",
        "patients": "street_address",
        "payers": "street_address",
        "providers": "specialty",
    }
    found = {
        f"landing_{feed}": f"SELECT * REPLACE ({awkward(c)} AS {c}) FROM stg_{feed}"
        for feed, c in staged.items()
    }
    found["landing_claims"] = f"""
SELECT claim_id, patient AS patient_id, provider AS provider_id,
  referring AS referring_provider_id, supervising AS supervising_provider_id,
  encounter AS encounter_id, insurance AS primary_insurance_id,
  {awkward('type1')} AS claim_type_1, type2 AS claim_type_2 FROM feed_claims"""
    found["landing_claims_transactions"] = f"""
SELECT transaction_id, claim_id, patient AS patient_id, provider AS provider_id,
  supervising AS supervising_provider_id, encounter AS encounter_id,
  {awkward('kind')} AS transaction_type, CASE WHEN kind = 'CHARGE' THEN money END AS amount,
  CASE WHEN kind = 'PAYMENT' THEN money END AS payments,
  CASE WHEN kind IN ('TRANSFERIN', 'TRANSFEROUT') THEN money END AS transfers
FROM feed_transactions"""
    found["landing_payer_transitions"] = f"""
SELECT payer AS payer_id, {awkward('second_payer')} AS secondary_payer_id FROM feed_transitions"""
    return found


def all_queries(thresholds: dict[str, tuple[int, int]]) -> dict[str, str]:
    """One statement per registered query."""
    models = [n for n in TABLES if n.startswith(("stg_", "dim_", "fct_"))]
    found = {n.replace("stg_", "stage_"): f"SELECT * FROM {n}" for n in models}
    found["stage_csv_roundtrip"] = "SELECT * FROM stg_patients"
    found |= {n: f"SELECT * FROM {n}" for n in ("published_dates", "protected_cohort")}
    generic = _generic()
    checks = _checks("dim_patient", "fct_encounter", "fct_condition")
    broken = _checks("open_patient", "open_encounter", "open_condition")
    found |= generic
    found |= {f"check_{name}": select for name, select in checks.items()}
    found |= {
        f"planted_{name}": broken[name]
        for name in (
            "patient_zip3_is_a_permitted_prefix",
            "safe_harbor_age_over_89_is_suppressed",
            "fact_age_and_date_do_not_imply_over_89",
            "fact_age_is_withheld_for_the_protected_cohort",
        )
    }
    found["check_summary"] = _summary(generic, checks, thresholds)
    found["profile_claims"] = _claim_figures()
    found["profile_payer_transitions"] = _SPANS
    shape = """CASE WHEN zip_code IS NULL THEN NULL
      WHEN length(zip_code) = 10 AND substr(zip_code, 6, 1) = '-'
        AND try_cast(left(zip_code, 5) || right(zip_code, 4) AS INTEGER) >= 0 THEN 'ZIP+4'
      WHEN regexp_full_match(zip_code, '[0-9]+') AND length(zip_code) IN (4, 5)
        THEN CASE length(zip_code) WHEN 4 THEN 'four digits' ELSE 'five digits' END
      ELSE 'other' END"""
    found["profile_zip_shapes"] = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, shape, count(*) AS n, "
        f"shape IS NULL OR shape IN ('five digits'{more}) AS is_permitted "
        f"FROM (SELECT {shape} AS shape FROM {table}) GROUP BY shape"
        for table, more in (
            ("stg_patients", ""),
            ("stg_organizations", ", 'ZIP+4', 'four digits'"),
            ("stg_providers", ", 'ZIP+4', 'four digits'"),
        )
    )
    found["unexpected_patient_zips"] = (
        f"SELECT * FROM stg_patients WHERE zip_code IS NOT NULL AND {shape} <> 'five digits'"
    )
    found["preview_json"] = f"""
SELECT CAST(to_json({{figure: figure, n: n, of_n: of_n}}) AS VARCHAR) AS line
FROM ({_SPANS}) LIMIT 50"""
    found |= _reports() | _table_profiles() | _landed()
    return {name: with_tables(select) for name, select in found.items()}
