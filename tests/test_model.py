"""Model steps (M1-M8): gate, skip, determinism, output shape."""

import pytest
from pyspark.sql import functions as F

from tillcast.config import V1
from tillcast.plans.forecast import best_iteration, train_and_forecast
from tillcast.plans.features import build_dataset, engineer_features
from tillcast.sources import testviews as tv

from tests.conftest import SF_MID, SF_SMALL


def test_best_iteration_patience_rule():
    errs = [10, 9, 8, 8.5, 9, 9, 9]
    assert best_iteration(errs, 3) == 3
    assert best_iteration([5, 4, 3, 2, 1], 30) == 5
    # stops after `patience` rounds without improvement: a later minimum is not reached
    assert best_iteration([5, 4, 6, 6, 6, 1], 2) == 2


@pytest.fixture(scope="module")
def cleaned_small(spark):
    tx = tv.tx_dense(spark, SF_SMALL)
    return build_dataset(engineer_features(tx, tv.holidays_for(tx), V1), V1)


def test_forecast_small_panel(spark, cleaned_small):
    cfg = V1.with_(max_iter=5)
    wide, run = train_and_forecast(cleaned_small, cfg)
    rows = wide.collect()
    assert len(rows) == cleaned_small.select("atm_id").distinct().count()
    # at sf0.001 every horizon has <= 100 validation rows: no early stopping
    assert [h.early_stopping for h in run.horizons] == [False, False, False]
    assert [h.val_rows for h in run.horizons][2] == 0
    for label, _, _ in cfg.horizons:
        vals = [r[f"predicted_dispense_{label}"] for r in rows]
        assert all(v is not None and v >= 0 and v == int(v) for v in vals)
    wide2, _ = train_and_forecast(cleaned_small, cfg)
    a = {r.atm_id: r.predicted_dispense_Next_Day for r in rows}
    b = {r.atm_id: r.predicted_dispense_Next_Day for r in wide2.collect()}
    assert a == b


def test_skip_horizon_without_training_rows(spark, cleaned_small):
    cfg = V1.with_(max_iter=3, horizons=(("Next_Day", "target_1day", 1), ("Far", "target_far", 1000)))
    data = cleaned_small.withColumn("target_far", F.lit(None).cast("double"))
    wide, run = train_and_forecast(data, cfg)
    assert run.horizons[1].skipped
    assert "predicted_dispense_Far" not in wide.columns
    assert "predicted_dispense_Next_Day" in wide.columns


def test_early_stopping_gate_on_mid_panel(spark):
    tx = tv.tx_dense(spark, SF_MID)
    cleaned = build_dataset(engineer_features(tx, tv.holidays_for(tx), V1), V1)
    cfg = V1.with_(max_iter=4, patience=2, horizons=(("Next_Day", "target_1day", 1),))
    _, run = train_and_forecast(cleaned, cfg)
    h = run.horizons[0]
    assert h.val_rows > 100 and h.early_stopping
    assert 1 <= h.trees <= 4
    strict = cfg.with_(early_stop_min_val_rows=h.val_rows)
    _, run2 = train_and_forecast(cleaned, strict)
    assert not run2.horizons[0].early_stopping and run2.horizons[0].trees == 4


def test_end_to_end_job_writes_partitioned_report(spark, tmp_path):
    import argparse

    from tillcast.plans import job

    tx = tv.tx_dense(spark, SF_SMALL)
    tx_path, hol_path, out = str(tmp_path / "tx"), str(tmp_path / "hol"), str(tmp_path / "report")
    tx.write.parquet(tx_path)
    tv.holidays_for(tx).write.parquet(hol_path)
    args = argparse.Namespace(preset="v1", max_iter=3, transactions=[tx_path], holidays=hol_path, calendar=None,
                              metadata=None, date_formats=None, input_format="parquet", out=out, format="parquet")
    run = job.run(spark, args)
    rep = spark.read.parquet(out)
    n_atm = tx.select("atm_id").distinct().count()
    assert rep.count() == 3 * n_atm
    assert {r.horizon for r in rep.select("horizon").distinct().collect()} == {"Next_Day", "Next_3_Days", "Next_Week"}
    assert rep.where("predicted_dispense_amount < 0").count() == 0
    assert all(not h.skipped for h in run.horizons)


def test_v2_preset_trains_on_long_panel(spark):
    from tillcast.config import V2
    from tillcast.plans.features import feature_dataset

    tx = tv.tx_long(spark, SF_SMALL)
    cfg = V2.with_(max_iter=3)
    wide, run = train_and_forecast(feature_dataset(tx, tv.holidays_for(tx), cfg), cfg)
    # v2: early stopping whenever there is any validation row; no floor at 0
    assert all(h.early_stopping == (h.val_rows > 0) for h in run.horizons)
    assert wide.count() == tx.select("atm_id").distinct().count()


def test_v0_preset_without_training_rows_fails_like_the_reference(spark):
    from tillcast.config import V0
    from tillcast.plans.features import feature_dataset

    tx = tv.tx_dense(spark, SF_SMALL)  # 30 days of data, 30-day validation window
    cfg = V0.with_(max_iter=2, calendar_years=(2024,))
    cleaned = feature_dataset(tx, cfg=cfg, calendar=tv.calendar_for(tx), metadata=tv.metadata(spark, SF_SMALL))
    with pytest.raises(ValueError, match="no training rows"):
        train_and_forecast(cleaned, cfg)


def test_first_k_trees_equal_a_k_tree_fit(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from tillcast.plans.forecast import score_first_trees

    df = spark.range(0, 800).select((F.rand(1) * 10).alias("a"), (F.rand(2) * 5).alias("b"))
    df = df.withColumn("y", F.col("a") * 2 + F.sin("b"))
    x = VectorAssembler(inputCols=["a", "b"], outputCol="_features").transform(df).select("_features", "y").persist()
    params = dict(featuresCol="_features", labelCol="y", maxDepth=3, seed=42)
    full = GBTRegressor(maxIter=12, predictionCol="_pred", **params).fit(x)
    for k in (1, 5):
        ref = GBTRegressor(maxIter=k, predictionCol="_ref", **params).fit(x)
        got = [r._pred for r in score_first_trees(full, x, k).collect()]
        want = [r._ref for r in ref.transform(x).collect()]
        assert max(abs(a - b) for a, b in zip(got, want)) < 1e-9


def test_stages_stop_like_the_whole_fit(spark):
    from pyspark.ml.feature import VectorAssembler

    from tillcast.plans import forecast as fc

    df = spark.range(0, 600).select((F.rand(1) * 10).alias("a"), (F.rand(2) * 5).alias("b"), (F.rand(3) * 4).alias("e"))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="_features").transform(df.withColumn("_label", F.col("a") + F.col("e"))).persist()
    train, val = df.where("b < 4"), df.where("b >= 4")
    est = fc.boosted_trees(V1.with_(max_iter=24, step_size=0.3, max_depth=3)).setFeaturesCol("_features").setLabelCol("_label").setPredictionCol("_pred")
    whole = est.fit(train)
    want = best_iteration(list(whole.evaluateEachIteration(val, "squared")), 3)
    fc.GROWTH, before = 4, fc.GROWTH
    try:
        model, k = fc.fit_stopped(est, train, val, 3)
    finally:
        fc.GROWTH = before
    assert k == want and model.getNumTrees <= whole.getNumTrees


def test_encoding_choice_does_not_follow_the_data():
    from tillcast.plans.forecast import split_categoricals

    cats = ["atm_id", "state", "holiday_name", "holiday_type"]
    for names in (10, 63, 64, 5_000):
        card = {"atm_id": 9, "state": 30, "holiday_name": names, "holiday_type": 5}
        assert split_categoricals(cats, card, V1) == (["state", "holiday_type"], ["atm_id", "holiday_name"])
    with pytest.raises(ValueError, match="max_bins"):
        split_categoricals(cats, {"state": 256}, V1)


def test_estimator_is_a_parameter(spark, cleaned_small):
    import numpy as np
    from pyspark.ml.regression import LinearRegression

    cfg = V1.with_(features=("dispense_lag_7",), horizons=(("Next_Day", "target_1day", 1),), clip_lower=False)
    wide, run = train_and_forecast(cleaned_small, cfg, LinearRegression(solver="normal"))
    train = cleaned_small.where(F.col("date") <= F.lit(run.split_date)).dropna(subset=["target_1day"]).toPandas()
    slope, intercept = np.polyfit(train.dispense_lag_7, train.target_1day, 1)
    for r in wide.collect():
        assert r.predicted_dispense_Next_Day == pytest.approx(round(slope * r.dispense_lag_7 + intercept), abs=1)
    assert not run.horizons[0].early_stopping


def test_job_reads_csv_parts_in_any_column_order(spark, tmp_path, capsys):
    from tillcast.plans import job
    from tillcast.sources.readers import read_parts

    tx = tv.tx_dense(spark, SF_SMALL)
    a, b, hol = (str(tmp_path / x) for x in ("a", "b", "hol"))
    first = F.col("atm_id") < "ATM_2"
    tx.where(first).select("date", "dispense", "state", "atm_id").write.csv(a, header=True)
    tx.where(~first).select("state", "atm_id", F.date_format("date", "dd-MMM-yyyy").alias("date"), "dispense").write.csv(b, header=True)
    tv.holidays_for(tx).write.csv(hol, header=True)
    argv = ["--transactions", a, b, "--holidays", hol, "--out", str(tmp_path / "out"), "--input-format", "csv", "--max-iter", "2",
            "--date-formats", "yyyy-MM-dd", "dd-MMM-yyyy"]
    job.main(argv)
    assert "could not be read: 0, 0" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3 * tx.select("atm_id").distinct().count()
    parts = read_parts(spark, [a, b], "csv", None, header="true")
    assert job.rows_lost(parts, V1)["date"] == tx.where(~first).count()


def test_training_rows_are_joined_once_and_lie_in_few_parts(spark, cleaned_small):
    """What every tree reads again and again: no joins in its plan, no task for a few rows."""
    from pyspark.ml.regression import LinearRegression

    seen = []

    class Noting(LinearRegression):
        def _fit(self, data):
            seen.append((data.rdd.getNumPartitions(), data._jdf.queryExecution().analyzed().toString()))
            return super()._fit(data)

    cfg = V1.with_(horizons=(("Next_Day", "target_1day", 1),))
    train_and_forecast(cleaned_small, cfg, Noting(solver="normal"))
    assert len(seen) == 1 and seen[0][0] == 1 and "Join" not in seen[0][1]
