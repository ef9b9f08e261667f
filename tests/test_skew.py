"""The chunked plan for hot machines gives exactly the rows of the one-exchange plan."""

import pytest
from pyspark.sql import functions as F

from tillcast.config import V0, V1, V2
from tillcast.operators import panel
from tillcast.operators.skew import with_halo
from tillcast.plans.features import feature_dataset
from tillcast.sources import testviews as tv

from tests.conftest import SF_SMALL

ALL_HOT = dict(hot_key_min_rows=0, chunk_rows=15)


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", ["v1", "v2", "v0"])
def test_chunked_equals_standard(spark, name):
    cfg = {"v0": V0.with_(calendar_years=(2024,)), "v1": V1, "v2": V2}[name]
    tx = tv.tx_nulls(spark, SF_SMALL)
    kw = ({"calendar": tv.calendar_for(tx), "metadata": tv.metadata(spark, SF_SMALL)} if name == "v0"
          else {"holidays": tv.holidays_for(tx)})
    std = feature_dataset(tx, cfg=cfg.with_(skew_guard=False), **kw)
    hot = feature_dataset(tx, cfg=cfg.with_(**ALL_HOT), **kw)
    _same(std, hot)


def test_chunked_equals_standard_on_dirty_input(spark):
    d = tv.tx_dirty(spark, SF_SMALL).drop("event_id")
    hols = tv.holidays_for(d.withColumn("date", F.try_to_date("date", "yyyy-MM-dd")))
    cfg = V1.with_(required_columns=("atm_id", "dispense"))  # keep undated rows: they sort last
    std = feature_dataset(d, hols, cfg.with_(skew_guard=False))
    hot = feature_dataset(d, hols, cfg.with_(**ALL_HOT))
    _same(std, hot)


def test_partial_hot_set_unions_both_branches(spark):
    tx = tv.tx_long(spark, SF_SMALL)
    hols = tv.holidays_for(tx)
    counts = sorted(r["n"] for r in tx.groupBy("atm_id").agg(F.count(F.lit(1)).alias("n")).collect())
    mid = counts[len(counts) // 2]
    cfg = V1.with_(hot_key_min_rows=mid, chunk_rows=50)
    assert 0 < panel.hot_machines(panel.machine_stats(tx), cfg).count() < len(counts)
    _same(feature_dataset(tx, hols, V1.with_(skew_guard=False)), feature_dataset(tx, hols, cfg))


def test_halo_copies(spark):
    df = spark.range(1, 21).withColumnRenamed("id", "_ord")
    h = with_halo(df, "_ord", 5, 2, 1).collect()
    home = [r for r in h if r._home]
    assert len(home) == 20
    copies = sorted((r._ord, r._chunk) for r in h if not r._home)
    # rows 4,5 -> chunk 1 (history), row 6 -> chunk 0 (lookahead), ...
    assert (4, 1) in copies and (5, 1) in copies and (6, 0) in copies and (3, 1) not in copies


def test_any_number_of_hot_machines(spark):
    """More than a thousand machines above the threshold all take the chunked plan."""
    rows = spark.range(1_200).selectExpr("concat('ATM_', id) AS atm_id", "'S' AS state", "explode(sequence(0, 19)) AS d").selectExpr(
        "atm_id", "state", "date_add(DATE '2024-01-01', d) AS date", "cast(d * 100 + 100 as double) AS dispense")
    hols = spark.createDataFrame([], "date date, state string, holiday_name string")
    cfg = V1.with_(hot_key_min_rows=10, chunk_rows=15)
    assert panel.hot_machines(panel.machine_stats(rows), cfg).count() == 1_200
    _same(feature_dataset(rows, hols, V1.with_(skew_guard=False)), feature_dataset(rows, hols, cfg))


@pytest.mark.parametrize("sizes", [(1, 14), (1, 1), (10, 15), (1, 40)])
def test_days_of_many_rows_and_of_few(spark, sizes):
    """Chunks that are hardly longer than a frame, days that fill one, and (1, 40) days that must be divided."""
    import random

    rng = random.Random(sizes[1])
    data = [(f"ATM_{m}", "S", d, float(rng.randint(-5, 900)) if rng.random() < 0.9 else None) for m in range(3) for d in range(60) for _ in range(rng.choice(sizes))]
    tx = spark.createDataFrame(data, "atm_id string, state string, d int, dispense double").selectExpr(
        "atm_id", "state", "if(d = 59, null, date_add(DATE '2024-01-01', d)) AS date", "dispense")
    hols = spark.createDataFrame([("2024-01-05", "S", "A"), ("2024-01-05", "S", "B"), ("2024-01-09", "S", "C")], "date string, state string, holiday_name string").withColumn("date", F.to_date("date"))
    cfg = V1.with_(required_columns=("atm_id",), **ALL_HOT)
    _same(feature_dataset(tx, hols, cfg.with_(skew_guard=False)), feature_dataset(tx, hols, cfg))


def test_a_day_is_sent_to_every_chunk_that_reaches_it(spark):
    from tillcast.operators.skew import day_chunks

    sizes = [20, 1, 30, 2, 3, 5, 40, 1, 1]
    df = spark.createDataFrame([("A", d) for d, n in enumerate(sizes) for _ in range(n)], "atm_id string, d int").selectExpr("atm_id", "date_add(DATE '2024-01-01', d) AS date")
    back, fwd, rows = 14, 3, 20
    got = {(r._d_date.day - 1): (r._d_chunk, sorted(r._d_more)) for r in day_chunks(df, rows, back, fwd).collect()}
    first = [sum(sizes[:i]) for i in range(len(sizes))]
    home = [f // rows for f in first]
    starts = {c: min(f for f, h in zip(first, home) if h == c) for c in home}
    ends = {c: max(f + n for f, n, h in zip(first, sizes, home) if h == c) for c in home}
    for d, (f, n, h) in enumerate(zip(first, sizes, home)):
        more = [c for c in starts if c > h and starts[c] - back < f + n or c < h and ends[c] + fwd > f]
        assert got[d] == (h, sorted(more))


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_rows_of_a_task_are_bounded(spark, monkeypatch):
    """Windows of ordinary and of hot machines get tasks by the counted rows, and the same results."""
    from tillcast.operators import tasks

    tx = tv.tx_long(spark, SF_SMALL)
    hols = tv.holidays_for(tx)
    n = tx.count()
    cfg = V1.with_(skew_guard=False)
    want = feature_dataset(tx, hols, cfg)
    few = want.rdd.getNumPartitions()
    monkeypatch.setattr(tasks, "TASK_ROWS", n // 40)
    for c in (cfg, V1.with_(**ALL_HOT), V1.with_(hot_key_min_rows=0, chunk_rows=50)):
        got = feature_dataset(tx, hols, c)
        assert got.rdd.getNumPartitions() >= 40 > few
        _same(want, got)


def test_no_branch_for_machines_that_do_not_exist(spark):
    tx = tv.tx_nulls(spark, SF_SMALL)
    hols = tv.holidays_for(tx)
    assert "LeftAnti" not in plan_of(feature_dataset(tx, hols, V1.with_(**ALL_HOT)))
    assert "LeftAnti" not in plan_of(feature_dataset(tx, hols, V1))


def test_the_panel_of_lineitem_is_derived_once(spark):
    from tillcast.plans import catalog

    text = catalog._cleaned(spark, SF_SMALL, V1, "long")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in text
