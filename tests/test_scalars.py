from __future__ import annotations

import datetime as dt

import pytest

from wardstar.functions import scalars as s


def value(spark, expression: str):
    return spark.sql(f"select {expression} as v").first().v


@pytest.mark.parametrize(
    ("start", "end", "years"),
    [
        ("1990-12-31", "2020-01-01", 29),
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("2000-06-01", "1999-05-01", -2),
        ("2000-06-01", "2000-06-01", 0),
        ("1931-11-20", "2021-11-19", 89),
        ("1931-11-19", "2021-11-19", 90),
    ],
)
def test_completed_years(spark, start, end, years):
    got = value(spark, s.completed_years(f"date'{start}'", f"date'{end}'"))
    assert got == years


def test_completed_years_of_null(spark):
    assert value(spark, s.completed_years("cast(null as date)", "date'2020-01-01'")) is None


def test_completed_years_against_python(spark):
    rows = spark.sql(
        f"""select a, b, {s.completed_years('a', 'b')} as years from (
          select date_add(date'1904-01-01', cast(id * 37 % 40000 as int)) as a,
            date_add(date'1950-01-01', cast(id * 101 % 30000 as int)) as b
          from range(3000))"""
    ).collect()
    for r in rows:
        early = (r.b.month, r.b.day) < (r.a.month, r.a.day)
        assert r.years == r.b.year - r.a.year - early


def test_minutes_are_elapsed_not_boundaries(spark):
    def minutes(a, b):
        return value(spark, s.whole_minutes(f"timestamp_ntz'{a}'", f"timestamp_ntz'{b}'"))

    assert minutes("2020-06-15 10:00:50", "2020-06-15 10:01:10") == 0
    assert minutes("2020-01-01 23:50:00", "2020-01-02 00:10:30") == 20
    # A clock change in the session zone is no elapsed time.
    assert minutes("2020-03-08 01:00:00", "2020-03-08 04:00:00") == 180
    # Negative minutes are cut towards zero.
    assert minutes("2020-01-01 00:01:01", "2020-01-01 00:00:00") == -1


def test_seconds_cut_fractions_first(spark):
    seconds = s.elapsed_seconds(
        "timestamp_ntz'2020-01-01 10:00:00.9'", "timestamp_ntz'2020-01-01 10:00:01.1'"
    )
    assert value(spark, seconds) == 1


def test_zoned_text_keeps_the_wall_clock(spark):
    got = value(spark, "cast('2020-03-08T02:30:00Z' as timestamp_ntz)")
    assert got == dt.datetime(2020, 3, 8, 2, 30)


@pytest.mark.parametrize(
    ("label", "tag"),
    [
        ("Pneumonia (disorder)", "disorder"),
        ("A (b) (c)", "c"),
        ("Severe anxiety (panic) (finding", None),
        ("Stress (finding)\n", None),
        ("Plain", None),
        ("Empty ()", None),
    ],
)
def test_trailing_tag(spark, label, tag):
    frame = spark.createDataFrame([(label,)], "label string")
    assert frame.selectExpr(f"{s.trailing_tag('label')} as v").first().v == tag


def test_collapse_whitespace(spark):
    frame = spark.createDataFrame([(" a \t b\n\nc\x0bd ",)], "v string")
    # A vertical tab is not whitespace here.
    assert frame.selectExpr(f"{s.collapse_whitespace('v')} as v").first().v == "a b c\x0bd"


def test_zip_prefix(spark):
    assert value(spark, s.zip_prefix("'02139'")) == "021"
    assert value(spark, s.zip_prefix("'03601'")) == "000"
    assert value(spark, s.zip_prefix("cast(null as string)")) is None
    assert value(spark, s.is_zip_prefix("'021'")) is True
    assert value(spark, s.is_zip_prefix("'021\\n'")) is False
    assert value(spark, s.is_zip_prefix("'02139'")) is False


def test_plus_years_clamps_leap_day(spark):
    assert value(spark, s.plus_years("date'2020-02-29'", 1)) == dt.date(2021, 2, 28)
    assert value(spark, s.plus_years("date'2020-02-29'", "-1")) == dt.date(2019, 2, 28)


def test_payer_classes(spark):
    names = ["NO_INSURANCE", "Medicare", "Medicaid", "Dual Eligible", "Other"]
    classes = [value(spark, s.payer_class(s.text(n))) for n in names]
    assert classes == ["self_pay", "medicare", "medicaid", "dual_eligible", "commercial"]
    rollups = [value(spark, s.payer_rollup(s.text(c))) for c in classes]
    assert rollups == ["self_pay", "public", "public", "public", "commercial"]
    assert value(spark, s.payer_class("cast(null as string)")) == "commercial"


def test_strict_casts(spark):
    import decimal

    assert value(spark, "cast('129.165' as decimal(18,2))") == decimal.Decimal("129.17")
    assert value(spark, "cast('-0.005' as decimal(18,2))") == decimal.Decimal("-0.01")
    for bad in ("cast('12.6' as int)", "cast('' as int)", "cast('x' as date)"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            value(spark, bad)


def test_text_literals_are_escaped(spark):
    assert value(spark, s.text("it's a \\ line")) == "it's a \\ line"


@pytest.mark.parametrize(
    ("value", "shape"),
    [
        ("02139", "five digits"), ("2139", "four digits"), ("02139-4307", "ZIP+4"), ("1A309", "other"),
        ("", "other"), ("02139\n", "other"), ("021394307", "other"), (None, None),
    ],
)
def test_zip_shapes(spark, value, shape):
    rows = spark.createDataFrame([(value,)], "z string")
    assert rows.selectExpr(f"{s.zip_shape('z')} as shape").first().shape == shape
