from __future__ import annotations

import pytest

from wardstar.plans.staging import STAGED_COLUMNS, stage
from wardstar.sources.feeds import FEED_COLUMNS, csv_feeds, read_feed, write_feed
from wardstar.sources.tables import TableFolder, preview_json, shared_folder

HEADER = "PATIENT,ENCOUNTER,START,STOP,CODE,DESCRIPTION\n"


def conditions(spark, folder, body: str, header: str = HEADER):
    path = folder / "conditions.csv"
    path.write_text(header + body)
    return read_feed(spark, "conditions", str(path))


def test_quotes_newlines_and_empty_fields(spark, tmp_path):
    body = (
        'p1,e1,2020-01-01,,007,"He said ""hi""\nand left"\n'
        'p2,e2,2020-01-02,"",1, padded \n'
    )
    rows = conditions(spark, tmp_path, body).collect()
    assert rows[0].DESCRIPTION == 'He said "hi"\nand left'
    assert (rows[0].STOP, rows[0].CODE) == (None, "007")
    assert (rows[1].STOP, rows[1].DESCRIPTION) == (None, " padded ")


def test_columns_are_found_by_name(spark, tmp_path):
    rows = conditions(
        spark,
        tmp_path,
        "x,A,p1,e1,2020-01-01,2020-01-02,secret\n",
        "DESCRIPTION,CODE,PATIENT,ENCOUNTER,START,STOP,SSN\n",
    )
    assert rows.columns == list(FEED_COLUMNS["conditions"])
    assert rows.first().PATIENT == "p1"


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="STOP"):
        conditions(spark, tmp_path, "p1,e1,x,A,d\n", "PATIENT,ENCOUNTER,START,CODE,DESCRIPTION\n")


def test_bad_row_is_an_error(spark, tmp_path):
    rows = conditions(spark, tmp_path, "p1,e1,2020-01-01,,A,d\np2,e2\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        rows.collect()


def test_identifiers_never_leave_the_scan(spark, tmp_path):
    columns = [*FEED_COLUMNS["patients"], "SSN", "DRIVERS", "PASSPORT"]
    path = tmp_path / "patients.csv"
    path.write_text(",".join(columns) + "\n" + ",".join(["1"] * len(columns)) + "\n")
    plan = csv_feeds(spark, str(tmp_path))["patients"]._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    for secret in ("SSN", "DRIVERS", "PASSPORT"):
        assert secret not in physical
        assert all(secret != source for source, _, _ in STAGED_COLUMNS["patients"])


def test_roundtrip_through_csv(spark, tmp_path, star):
    path = str(tmp_path / "conditions.csv")
    write_feed(star.feeds["conditions"], path)
    again = stage("conditions", read_feed(spark, "conditions", path))
    assert sorted(map(str, again.collect())) == sorted(
        map(str, star.table("stg_conditions").collect())
    )


def test_staging_covers_every_feed_column():
    for feed, columns in STAGED_COLUMNS.items():
        assert [source for source, _, _ in columns] == list(FEED_COLUMNS[feed])
    counts = {feed: len(columns) for feed, columns in STAGED_COLUMNS.items()}
    assert counts == {
        "patients": 22, "encounters": 15, "conditions": 6, "organizations": 11,
        "providers": 12, "payers": 21,
    }


def test_bad_text_is_an_error(spark, tmp_path):
    rows = conditions(spark, tmp_path, "p1,e1,2020-13-01,,A,d\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage("conditions", rows).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            stage("conditions", rows)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_unknown_feed(spark, tmp_path):
    with pytest.raises(KeyError):
        csv_feeds(spark, str(tmp_path))["allergies"]


def test_tables_are_replaced(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path))
    folder.write("t", spark.range(5))
    assert folder.write("t", spark.range(3)).count() == 3


def test_preview_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "n int, t string").orderBy("n")
    lines = [r.line for r in preview_json(rows, 1).collect()]
    assert lines == ['{"n":1,"t":null}']


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
