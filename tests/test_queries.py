"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_of_the_star_has_sql():
    own = registry.own_queries()
    assert len(own) > 60
    assert set(own) <= set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_no_row_is_left_out():
    for name, sql in registry.oracle_sql().items():
        if name not in ("preview_json", "report_top_conditions"):
            assert not re.search(r"\bLIMIT\b|TABLESAMPLE", sql), name


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    frame = registry.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [tuple(str(row[c]) for c in columns) for row in frame.collect()]
    result = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(str(row[i]) for i in order) for row in result.fetchall()]
    assert sorted(got) == sorted(expected)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
