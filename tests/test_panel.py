
import datetime as dt

import pytest

from tillcast.config import V1, V2
from tillcast.operators import panel
from tillcast.plans.features import build_dataset, engineer_features
from tillcast.sources import testviews as tv

from tests.conftest import SF_SMALL

TX = "atm_id string, date date, state string, dispense double"
HOL = "date date, state string, holiday_name string"


def _hol(spark, rows=()):
    return spark.createDataFrame(list(rows), HOL)


def _series(n, start=dt.date(2026, 1, 5), values=None):
    values = values or [float(i + 1) for i in range(n)]
    return [("A", start + dt.timedelta(days=i), "S", v) for i, v in enumerate(values)]


def test_rolling_min_periods(spark):
    vals = [1.0, 2.0, None] + [float(i) for i in range(4, 16)]
    tx = spark.createDataFrame(_series(15, values=vals), TX)
    f = engineer_features(tx, _hol(spark), V1.with_(drop_inactive=False, required_columns=("atm_id", "date")))
    rows = f.orderBy("date").collect()
    r7 = [r.dispense_roll_mean_7 for r in rows]
    assert r7[:10] == [None] * 10 and r7[10:] == [7.0, 8.0, 9.0, 10.0, 11.0]
    r14 = [r.dispense_roll_mean_14 for r in rows]
    assert r14[:12] == [None] * 12
    assert r14[12:] == pytest.approx([75 / 11, 88 / 12, 102 / 13], rel=0, abs=1e-12)


def test_long_weekend_with_holiday_monday(spark):
    days = [dt.date(2026, 8, d) for d in (13, 14, 15, 16, 17, 18)]
    tx = spark.createDataFrame([("A", d, "S", 10.0) for d in days], TX)
    hol = _hol(spark, [(dt.date(2026, 8, 17), "S", "Independence Day")])
    f = engineer_features(tx, hol, V1).orderBy("date").collect()
    assert [r.is_long_weekend for r in f] == [0, 0, 1, 1, 1, 0]
    assert [r.is_pre_holiday for r in f] == [0, 0, 0, 1, 0, 0]


def test_long_weekend_is_row_based(spark):
    days = [dt.date(2026, 8, d) for d in (1, 2, 8, 9)]
    tx = spark.createDataFrame([("A", d, "S", 10.0) for d in days], TX)
    f = engineer_features(tx, _hol(spark), V1).collect()
    assert all(r.is_long_weekend == 1 for r in f)


def test_pre_holiday_last_row_is_zero(spark):
    tx = spark.createDataFrame(_series(3), TX)
    f = engineer_features(tx, _hol(spark), V1).orderBy("date").collect()
    assert f[-1].is_pre_holiday == 0


def test_null_state_matches_null_state(spark):
    tx = spark.createDataFrame([("A", dt.date(2026, 1, 26), None, 5.0)], TX)
    hol = _hol(spark, [(dt.date(2026, 1, 26), None, "Republic Day")])
    f = engineer_features(tx, hol, V1).first()
    assert f.is_holiday == 1 and f.holiday_type == "NATIONAL"


def test_two_names_fan_out_and_shift_lags(spark):
    d = dt.date(2026, 1, 15)
    tx = spark.createDataFrame([("A", d, "S", 7.0), ("A", d + dt.timedelta(days=1), "S", 9.0)], TX)
    hol = _hol(spark, [(d, "S", "Pongal"), (d, "S", "Makar Sankranti"), (d, "S", "Pongal")])
    f = engineer_features(tx, hol, V1).orderBy("date", "holiday_name").collect()
    assert [r.holiday_name for r in f] == ["Makar Sankranti", "Pongal", "Regular Day"]
    assert f[1].dispense_lag_1 == 7.0 and f[2].dispense_lag_2 == 7.0


def test_undated_row_sorts_last(spark):
    rows = _series(3) + [("A", None, "S", 100.0)]
    tx = spark.createDataFrame(rows, TX)
    f = engineer_features(tx, _hol(spark), V1.with_(required_columns=("atm_id", "dispense")))
    got = {r.date: r.dispense_lag_1 for r in f.collect()}
    assert got[dt.date(2026, 1, 5)] is None
    assert got[None] == 3.0


def test_min_history_eligibility(spark):
    tx = spark.createDataFrame(_series(12), TX)
    assert build_dataset(engineer_features(tx, _hol(spark), V1), V1).count() == 1
    assert build_dataset(engineer_features(tx, _hol(spark), V2), V2).count() == 0


def test_inactive_machines(spark):
    rows = (_series(3) + [("Z", dt.date(2026, 1, 5), "S", 0.0), ("N", dt.date(2026, 1, 5), "S", None),
                          ("M", dt.date(2026, 1, 5), "S", -4.0), (None, dt.date(2026, 1, 5), "S", 3.0)])
    tx = spark.createDataFrame(rows, TX)
    kept = {r.atm_id for r in panel.drop_inactive(tx).collect()}
    assert kept == {"A"}
    assert panel.removed_atm_count(tx).first().removed_atms == 2


def test_pandas_cross_check_lags_and_rolling(spark):
    """Independent pandas computation of W4-W7 on the B7 panel (scattered NULLs)."""
    tx = tv.tx_nulls(spark, SF_SMALL)
    cfg = V1
    f = engineer_features(tx, spark.createDataFrame([], HOL), cfg).toPandas()
    p = tx.toPandas().sort_values(["atm_id", "date"]).reset_index(drop=True)
    p["dispense"] = p["dispense"].astype("float64")
    g = p.groupby("atm_id")["dispense"]
    p["lag7"] = g.shift(7)
    p["r7"] = g.transform(lambda x: x.shift(1).rolling(7).mean())
    p["r14"] = g.transform(lambda x: x.shift(1).rolling(14, min_periods=11).mean())
    p = p.dropna(subset=["dispense"])
    m = f.merge(p, on=["atm_id", "date"], suffixes=("", "_pd"))
    assert len(m) == len(f) == len(p)
    for a, b in (("dispense_lag_7", "lag7"), ("dispense_roll_mean_7", "r7"), ("dispense_roll_mean_14", "r14")):
        left, right = m[a].astype("float64"), m[b].astype("float64")
        assert (left.isna() == right.isna()).all(), a
        assert ((left - right).abs().fillna(0) < 1e-6).all(), a


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_single_exchange_on_atm_id(spark, tmp_path):
    path = str(tmp_path / "tx")
    tv.tx_dense(spark, SF_SMALL).write.parquet(path)
    tx = spark.read.parquet(path)
    hol = spark.createDataFrame([(dt.date(2024, 1, 26), "NATION_1", "Republic Day")], HOL)
    cleaned = build_dataset(engineer_features(tx, hol, V1), V1)
    latest = panel.latest_per_atm(cleaned.select("atm_id", "date", "state", "holiday_name", "dispense"))
    plan = _plan(latest)
    lines = plan.splitlines()
    exchanges = [(i, ln) for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    # A shuffle fed by a map-side aggregate (partial sums, DISTINCT of the dimension)
    # moves per-key results, not panel rows.
    panel_shuffles = [ln for i, ln in exchanges if "HashAggregate" not in lines[i + 1]]
    assert len(panel_shuffles) == 1 and "hashpartitioning(atm_id" in panel_shuffles[0]
    # ... and the panel is sorted once: every window shares one order
    assert sum(1 for ln in lines if "Sort [atm_id" in ln) == 1
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert 1 <= plan.count("Window [") <= 4  # windows of unused columns are pruned by Catalyst


def test_empty_dataset_guard(spark):
    from tillcast.operators.dataset import ensure_not_empty

    tx = spark.createDataFrame(_series(5), TX)  # too short: nothing eligible
    cleaned = build_dataset(engineer_features(tx, _hol(spark), V1), V1)
    with pytest.raises(ValueError, match="No data available"):
        ensure_not_empty(cleaned)


def test_feature_chain_runs_once_for_splits_and_report(spark):
    """The final plans read the materialised panel: no window, sort or panel exchange is repeated."""
    from tillcast.plans import catalog

    for q in (catalog.q_time_split, catalog.q_split_diagnostics, catalog.q_horizon_training_sets, catalog.q_report_long):
        plan = q(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "hashpartitioning(atm_id" not in plan, q.__name__
