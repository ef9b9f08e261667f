"""Stored panel, dated report, grouped scans of parts, counts in the pass of the write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillcast.config import V1
from tillcast.operators import holidays as hol
from tillcast.operators.report import sheet_names
from tillcast.plans import ingest
from tillcast.plans.features import feature_dataset
from tillcast.session import scratch_path
from tillcast.sources import panel_store
from tillcast.sources import testviews as tv
from tillcast.sources.readers import read_parts
from tillcast.sources.sinks import write_report


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_panel_is_read_without_a_shuffle(spark, tmp_path):
    tx = tv.tx_dense(spark, SF_SMALL)
    table = "panel_test_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    panel_store.write_panel(tx, table, str(tmp_path / "p"), buckets=4)
    try:
        stored = panel_store.read_panel(spark, table)
        assert len(list((tmp_path / "p").glob("part-*.parquet"))) <= 4
        assert stored.exceptAll(tx).count() == 0 and tx.exceptAll(stored).count() == 0
        days = tv.holidays_for(tx).persist()
        cfg = V1.with_(skew_guard=False)
        plan = plan_of(feature_dataset(stored, days, cfg))
        assert "hashpartitioning(atm_id" not in plan and "Window" in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert "hashpartitioning(atm_id" in plan_of(feature_dataset(tx, days, cfg))
        assert feature_dataset(stored, days, cfg).exceptAll(feature_dataset(tx, days, cfg)).count() == 0
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_panel_buckets_grow_with_the_rows():
    assert panel_store.panel_buckets(10) == 8 and panel_store.panel_buckets(10**9) == 250


def report_of(spark, day, amounts, rows):
    data = [(h, f"ATM_{i:03d}", day + dt.timedelta(k), float(a)) for h, k in (("Next_Day", 1), ("Next_Week", 7)) for i, a in enumerate(amounts)]
    return sheet_names(spark.createDataFrame(data, "horizon string, atm_id string, forecast_date date, amount double"), V1, rows)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_keeps_other_dates_and_replaces_its_own(spark, tmp_path, fmt):
    out = str(tmp_path / "r")
    first, second, again = report_of(spark, dt.date(2024, 1, 1), range(25), 4), report_of(spark, dt.date(2024, 1, 2), range(25, 50), 10), report_of(spark, dt.date(2024, 1, 1), range(60, 82), 10)
    for r, rows in ((first, 4), (second, 10), (again, 10)):
        write_report(r, out, fmt, max_rows_per_file=rows)
    reader = spark.read.option("header", True).option("inferSchema", True) if fmt == "csv" else spark.read
    back = reader.format(fmt).load(out).select(*[F.col(c).cast("string") for c in ("horizon", "forecast_date", "atm_id", "sheet")], F.col("amount").cast("double").alias("amount"))
    want = second.unionByName(again).select(*[F.col(c).cast("string") for c in ("horizon", "forecast_date", "atm_id", "sheet")], "amount")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    files = list((tmp_path / "r").glob(f"horizon=*/forecast_date=*/part-*.{fmt}*"))
    assert len(files) <= want.select("horizon", "forecast_date", "sheet").distinct().count()
    sheets = reader.format(fmt).load(out).withColumn("file", F.input_file_name()).groupBy("horizon", "forecast_date", "sheet").agg(F.countDistinct("file").alias("files"))
    assert sheets.agg(F.max("files")).first()[0] == 1  # a sheet is in one file


def csv_parts(tmp_path, n):
    """n files of three headers."""
    heads = (["atm_id", "date", "dispense"], ["dispense", "atm_id", "state", "date"], ["date", "note", "atm_id", "dispense"])
    paths, want = [], []
    for i in range(n):
        head, p = heads[i % 3], tmp_path / f"part {i:04d}+x.csv"
        row = {"atm_id": f"A{i}", "date": "2024-01-01", "dispense": str(i), "state": f"S{i % 4}", "note": '"a, b"'}
        p.write_text(",".join(head) + "\n" + "".join(",".join(row[c] for c in head) + "\n" for _ in range(i % 3)))
        paths.append(str(p))
        want += [(f"A{i}", str(i), row["state"] if "state" in head else None, "a, b" if "note" in head else None, i + 1)] * (i % 3)
    return paths, want


def test_many_parts_are_one_scan_for_each_header(spark, tmp_path):
    paths, want = csv_parts(tmp_path, 240)
    df = read_parts(spark, paths, "csv", header="true")
    got = [tuple(r) for r in df.select("atm_id", "dispense", "state", "note", "part").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert plan_of(df).count("FileScan csv") == 3
    assert plan_of(read_parts(spark, paths, "csv", None, header="true")).count("FileScan csv") == 3
    assert df.where("dispense = '4'").select("atm_id").collect()[0][0] == "A4"


def test_a_part_given_twice_counts_twice_and_folders_are_parts(spark, tmp_path):
    tv.tx_dense(spark, SF_SMALL).limit(30).repartition(3).write.csv(str(tmp_path / "d"), header=True)
    one = str(tmp_path / "d")
    df = read_parts(spark, [one, one], "csv", header="true")
    assert df.groupBy("part").count().orderBy("part").collect() == [(1, 30), (2, 30)]
    assert read_parts(spark, [one, one], "csv", None, header="true").count() == 60
    with pytest.raises(ValueError, match="no parts"):
        read_parts(spark, [], "csv", header="true")
    (tmp_path / "e.csv").write_text("")
    assert read_parts(spark, [one, str(tmp_path / "e.csv")], "csv", header="true").count() == 30


def test_parquet_parts_are_one_scan_unless_types_differ(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    spark.createDataFrame([("A", 1.5)], "atm_id string, dispense double").write.parquet(a)
    spark.createDataFrame([("B", "S")], "atm_id string, state string").write.parquet(b)
    spark.createDataFrame([("C", "x")], "atm_id string, dispense string").write.parquet(c)
    df = read_parts(spark, [a, b])
    assert plan_of(df).count("FileScan parquet") == 1
    assert sorted((r.atm_id, r.dispense, r.state, r.part) for r in df.collect()) == [("A", 1.5, None, 1), ("B", None, "S", 2)]
    mixed = read_parts(spark, [a, b, c])
    assert sorted((r.atm_id, r.dispense, r.part) for r in mixed.collect()) == [("A", "1.5", 1), ("B", None, 2), ("C", "x", 3)]


def test_ingest_counts_in_the_pass_that_writes(spark, tmp_path):
    paths, want = csv_parts(tmp_path, 12)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ingest-test", "ingest")
    try:
        got = ingest.ingest(spark, str(tmp_path / "out"), paths)
        jobs = len(tracker.getJobIdsForGroup("ingest-test"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {"n_parts": 8, "n_rows": len(want)}  # four parts have no rows
    back = spark.read.parquet(str(tmp_path / "out" / "transactions"))
    assert (back.select("part").distinct().count(), back.count()) == (8, len(want))
    # a schema and a table of files for each header, and the write: none reads what was written
    assert jobs <= 3 + 3 + 1


def test_one_holiday_per_day_reduces_names_and_keeps_flags(spark):
    cfg = V1.with_(one_holiday_per_day=True)
    rows = [("2024-10-02", "s1", "Gandhi Jayanti"), ("2024-10-02", "S1 ", "Diwali"), ("2024-10-02", "S1", "4th Sat"), ("2024-10-03", "S1", "Eid"), ("2024-10-03", "S1", "Christmas"),
            ("2024-10-04", "S1", None), ("2024-10-04", "S1", "Local day"), ("2024-10-05", None, "2nd Sat"), ("2024-10-05", None, "2nd Sat")]
    raw = spark.createDataFrame(rows, "date string, state string, holiday_name string").withColumn("date", F.to_date("date"))
    got = sorted((str(r.date), r.state or "", r.holiday_name, r.holiday_type, r.is_holiday, r.is_major_festival) for r in hol.holiday_dimension(raw, cfg).collect())
    assert got == [("2024-10-02", "S1", "Gandhi Jayanti", "NATIONAL", 1, 1), ("2024-10-03", "S1", "Christmas", "FESTIVAL", 1, 1), ("2024-10-04", "S1", "Local day", "STATE", 1, 0),
                   ("2024-10-05", "", "2nd Sat", "BANK", 1, 0)]
    tx = spark.createDataFrame([("A", "2024-10-02", "S1", 1.0), ("A", "2024-10-05", None, 2.0)], "atm_id string, date string, state string, dispense double").withColumn("date", F.to_date("date"))
    assert hol.join_holidays(tx, hol.holiday_dimension(raw, cfg), cfg).count() == 2 < hol.join_holidays(tx, hol.holiday_dimension(raw, V1), V1).count()
    assert hol.holiday_dimension(raw, cfg).dtypes == hol.holiday_dimension(raw, V1).dtypes


def test_dated_reports_share_their_rows(spark, monkeypatch):
    """The feature chain runs once for the three reports, not once a report."""
    from tests.conftest import SF_SMALL
    from tillcast.operators import report
    from tillcast.plans import catalog

    def again(df):
        raise AssertionError("the report's rows are derived again")

    monkeypatch.setattr(report, "cut_lineage", again)
    assert catalog.queries()["report_dated_sink"](spark, SF_SMALL).count() > 0
