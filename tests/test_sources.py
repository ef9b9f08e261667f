"""Readers, sinks, sheet numbering and the distributed ordinal."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillcast.config import V1
from tillcast.operators.ordinal import with_ordinal
from tillcast.operators.report import sheet_names
from tillcast.sources.readers import ingest_counts, read_parts, require_columns, union_parts
from tillcast.sources.sinks import write_parquet, write_report


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "atm_id int")
    with pytest.raises(ValueError, match="transactions is missing required columns"):
        require_columns(df, ["atm_id", "date", "dispense"], "transactions")


def test_union_parts_by_name_with_mixed_types(spark):
    a = spark.createDataFrame([("A", 1.5)], "atm_id string, dispense double")
    b = spark.createDataFrame([("x", "B")], "dispense string, atm_id string")
    c = spark.createDataFrame([("C", "S1")], "atm_id string, state string")
    u = union_parts([a, b, c], "part")
    rows = sorted(u.collect(), key=lambda r: r.part)
    assert [r.atm_id for r in rows] == ["A", "B", "C"]
    assert rows[0].dispense == "1.5" and rows[1].dispense == "x" and rows[2].dispense is None
    assert rows[2].state == "S1" and rows[0].state is None
    counts = ingest_counts(u).first()
    assert (counts.n_parts, counts.n_rows) == (3, 3)


def test_read_parts_and_round_trip(spark, tmp_path):
    p1, p2 = str(tmp_path / "p1"), str(tmp_path / "p2")
    write_parquet(spark.createDataFrame([("A", 1.0)], "atm_id string, dispense double"), p1)
    write_parquet(spark.createDataFrame([("B", "2024-01-01")], "atm_id string, date string"), p2)
    u = read_parts(spark, [p1, p2])
    assert u.count() == 2 and set(u.columns) == {"atm_id", "dispense", "date", "part"}


def test_ordinal_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 5000).alias("v"))
    got = with_ordinal(df, ["g"], [F.col("v").asc()], "rn", num_partitions=7)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v")))
    j = got.join(ref, ["g", "v"])
    assert j.where(F.col("rn") != F.col("rn2")).count() == 0 and j.count() == 5000


def test_sheet_names_overflow_and_sink(spark, tmp_path):
    rows = [("Next_Day", f"ATM_{i:03d}", dt.date(2024, 1, 31)) for i in range(25)]
    rep = spark.createDataFrame(rows, "horizon string, atm_id string, forecast_date date")
    named = sheet_names(rep, V1, max_rows=10).orderBy("atm_id").collect()
    assert [r.part for r in named][:11] == [1] * 10 + [2]
    assert named[0].sheet == "31-Jan-2024_P1" and named[-1].sheet == "31-Jan-2024_P3"
    single = sheet_names(rep, V1, max_rows=100).first()
    assert single.sheet == "31-Jan-2024"
    out = str(tmp_path / "report")
    write_report(sheet_names(rep, V1, max_rows=10), out, max_rows_per_file=10)
    back = spark.read.parquet(out)
    assert back.count() == 25 and back.select("sheet").distinct().count() == 3


def test_ingest_job_stacks_csv_parts_by_name(spark, tmp_path, capsys):
    from pyspark.sql import functions as F

    from tillcast.plans import ingest
    from tillcast.sources import testviews as tv
    from tests.conftest import SF_SMALL

    tx = tv.tx_dense(spark, SF_SMALL)
    a, b, hol, meta, out = (str(tmp_path / x) for x in ("a", "b", "hol", "meta", "out"))
    first = F.col("atm_id") < "ATM_2"
    tx.where(first).select("date", "dispense", "atm_id").write.csv(a, header=True)
    tx.where(~first).select("state", "atm_id", "date", "dispense").write.csv(b, header=True)
    days = tv.holidays_for(tx)
    days.unionByName(days).write.csv(hol, header=True)
    tv.metadata(spark, SF_SMALL).write.csv(meta, header=True)
    ingest.main(["--out", out, "--transactions", a, b, "--holidays", hol, "--metadata", meta])
    assert f"2 parts, {tx.count()} rows" in capsys.readouterr().out
    back = spark.read.parquet(out + "/transactions").selectExpr("atm_id", "cast(date as date) as date", "cast(dispense as bigint) as dispense")
    want = tx.selectExpr("atm_id", "date", "cast(dispense as bigint) as dispense")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    assert spark.read.parquet(out + "/holiday_master").count() == days.distinct().count()
    assert spark.read.parquet(out + "/atm_metadata").count() == tv.metadata(spark, SF_SMALL).count()


def test_held_tables_are_released(spark):
    from tillcast.operators import joins

    joins.release()
    small, ok = joins.checked_broadcast(spark.range(5), 10)
    big, no = joins.checked_broadcast(spark.range(50), 10)
    assert ok and not no and len(joins._HELD) == 1 and not big.storageLevel.useMemory
    joins.release()
    assert not joins._HELD and small.count() == 5
