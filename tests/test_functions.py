"""Micro-cases for the column expressions (FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.functions.calendar import calendar_columns
from tillcast.functions.coerce import normalize_key, to_date_lenient, to_date_strict, to_number, to_percent_number
from tillcast.functions.holiday import holiday_type, is_major_festival
from tillcast.functions.numeric import postprocess_prediction


@pytest.mark.parametrize("name,kind,major", [
    ("Holi", "FESTIVAL", 1),
    ("Bank Holiday", "FESTIVAL", 1),
    ("2nd Sat Holiday", "BANK", 1),
    ("Financial Year End", "BANK", 0),
    ("Eid-ul-Fitr", "FESTIVAL", 1),
    ("Pongal", "FESTIVAL", 0),
    ("Good Friday", "FESTIVAL", 0),
    ("Republic Day", "NATIONAL", 0),
    ("Gandhi Jayanti", "NATIONAL", 0),
    ("Ugadi", "STATE", 0),
    (None, "STATE", 0),
])
def test_holiday_rules(spark, name, kind, major):
    df = spark.createDataFrame([(name,)], "n string")
    row = df.select(holiday_type(F.col("n")).alias("t"), is_major_festival(F.col("n")).alias("m")).first()
    assert (row.t, row.m) == (kind, major)


def test_numeric_coercion(spark):
    vals = ["1d", "NaN", "", "1,000", " 12 ", "1e3", "-2.5", "n/a", None, "inf"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r.y for r in df.select(to_number(df, "x").alias("y")).collect()]
    assert got[:8] == [None, None, None, None, 12.0, 1000.0, -2.5, None]
    assert got[8] is None and got[9] == float("inf")


def test_numeric_nan_in_double_column_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert [r.y for r in df.select(to_number(df, "x").alias("y")).collect()] == [None, 1.5]


def test_percent_coercion(spark):
    df = spark.createDataFrame([("98%",), ("n/a%",), (None,), ("12.5",)], "p string")
    assert [r.y for r in df.select(to_percent_number(df, "p").alias("y")).collect()] == [98.0, None, None, 12.5]


def test_date_coercion_lenient_and_strict(spark):
    df = spark.createDataFrame([("2024-01-15",), ("bad",), ("15/01/2024",), (None,)], "d string")
    assert [r.y for r in df.select(to_date_lenient(df, "d").alias("y")).collect()] == [
        dt.date(2024, 1, 15), None, None, None]
    multi = [r.y for r in df.select(to_date_lenient(df, "d", ("yyyy-MM-dd", "dd/MM/yyyy")).alias("y")).collect()]
    assert multi[2] == dt.date(2024, 1, 15)
    good = spark.createDataFrame([("2024-01-15",)], "d string")
    assert good.select(to_date_strict(good, "d").alias("y")).first().y == dt.date(2024, 1, 15)
    with pytest.raises(Exception):
        df.select(to_date_strict(df, "d").alias("y")).collect()


def test_normalize_key_unicode_space(spark):
    df = spark.createDataFrame([("  maharashtra\t",), (None,)], "s string")
    assert [r.y for r in df.select(normalize_key(F.col("s")).alias("y")).collect()] == ["MAHARASHTRA", None]


def test_calendar_and_salary(spark):
    days = [dt.date(2026, 8, d) for d in (14, 15, 7, 8, 27, 28)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "date date")
    cols = calendar_columns("date")
    rows = df.select("date", *[c.alias(k) for k, c in cols.items()]).collect()
    assert rows[0].day_of_week == 4 and rows[0].is_friday == 1
    assert rows[1].is_weekend == 1
    assert [r.is_salary_period for r in rows[2:6]] == [1, 0, 0, 1]
    assert rows[6].day_of_week is None and rows[6].is_weekend == 0 and rows[6].is_salary_period == 0
    label = df.select(F.date_format(F.lit(dt.date(2026, 8, 15)), "dd-MMM-yyyy").alias("l")).first().l
    assert label == "15-Aug-2026"


def test_postprocess_half_even_and_floor(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.2,), (None,)], "p double")
    clipped = [r.y for r in df.select(postprocess_prediction(F.col("p"), True).alias("y")).collect()]
    raw = [r.y for r in df.select(postprocess_prediction(F.col("p"), False).alias("y")).collect()]
    assert clipped == [0.0, 2.0, 2.0, 0.0, None]
    assert raw[3] == -3.0
