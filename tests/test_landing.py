"""Landed feeds: whole, and dealt out again only where few files hold the rows."""

from __future__ import annotations

from test_plans import physical

from wardstar.sources.feeds import FEED_COLUMNS
from wardstar.sources.landing import Landing
from wardstar.sources.tables import TableFolder


def landed(spark, tmp_path, files: int):
    columns = FEED_COLUMNS["conditions"]
    rows = spark.range(0, 4000, 1, files).selectExpr(
        *[f"concat('a \"quoted\",\nline ', id, ' {c}') as {c}" for c in columns]
    )
    landing = Landing(spark, str(tmp_path / "landing"))
    landing.put("conditions", rows)
    return rows, landing.feeds()["conditions"]


def test_many_files_are_not_moved(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows, found = landed(spark, tmp_path, 2 * cores)
    assert sorted(rows.collect()) == sorted(found.collect())
    assert "Exchange" not in physical(found)


def test_one_file_is_dealt_out(spark, tmp_path):
    rows, found = landed(spark, tmp_path, 1)
    assert sorted(rows.collect()) == sorted(found.collect())
    assert "Exchange" in physical(found)


def test_written_tables_are_zstandard(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    assert folder.write("t", spark.range(5)).count() == 5
    assert list((tmp_path / "t").glob("*/part-*.zstd.parquet"))
