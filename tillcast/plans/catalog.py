"""Query catalog: one Spark query per inventory item, each paired with its DuckDB oracle.

Every query takes ``(spark, sf_dir)`` and reads the test tables of ``sf_dir`` in full.
Keys without an oracle (the model) are checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.config import HORIZONS, V0, V1, V2, ForecastConfig
from tillcast.functions.calendar import calendar_columns
from tillcast.functions.coerce import normalize_key, to_date_lenient, to_number, to_percent_number
from tillcast.functions.holiday import holiday_type, is_major_festival
from tillcast.functions.numeric import postprocess_prediction
from tillcast.operators import dataset as ds
from tillcast.operators import holidays as hol
from tillcast.operators import metadata as meta
from tillcast.operators import panel, skew
from tillcast.operators.categories import category_codes
from tillcast.operators.report import report_long, sheet_names
from tillcast.plans import oracle as O
from tillcast.plans.features import engineer_features, feature_dataset, guarded, prepare_transactions
from tillcast.session import cut_lineage, scratch_path, stored
from tillcast.sources import testviews as tv
from tillcast.sources.readers import ingest_counts, union_parts
from tillcast.sources.panel_store import read_panel, write_panel
from tillcast.sources.sinks import write_parquet, write_report

Query = Callable[[SparkSession, str], DataFrame]

# Years of the test panels' country calendar (the preset's own years lie outside the data).
DENSE_V0 = V0.with_(calendar_years=(2024,))
REPORT_SHEET_ROWS = 40  # small sheet limit so the test report overflows into parts


# ----------------------------------------------------------------------------- inputs
def _dense(spark, sf):
    return tv.tx_dense(spark, sf)


def _features(spark, sf, cfg: ForecastConfig = V1, tx: str = "dense") -> DataFrame:
    maker = {"dense": tv.tx_dense, "nulls": tv.tx_nulls, "inactive": tv.tx_inactive, "long": tv.tx_long}[tx]
    t = maker(spark, sf)
    if cfg.holiday_source == "calendar":
        return engineer_features(t, cfg=cfg, calendar=tv.calendar_for(t), metadata=tv.metadata(spark, sf))
    return engineer_features(t, tv.holidays_for(t), cfg)


def _cleaned(spark, sf, cfg: ForecastConfig = V1, tx: str = "dense") -> DataFrame:
    maker = {"dense": tv.tx_dense, "nulls": tv.tx_nulls, "inactive": tv.tx_inactive, "long": tv.tx_long,
             "skewed": tv.tx_skewed}[tx]
    t = maker(spark, sf)
    if tx in ("long", "skewed"):  # read by the holidays, the machines' rows, the days and the windows: derived once
        t = stored(t, f"tx-{tx}")
    if cfg.holiday_source == "calendar":
        return feature_dataset(t, cfg=cfg, calendar=tv.calendar_for(t), metadata=tv.metadata(spark, sf))
    return feature_dataset(t, tv.holidays_for(t), cfg)


# Skew-guard settings that send every machine through the chunked plan, with chunks
# small enough that every machine spans several of them (results must not change).
ALL_HOT = dict(hot_key_min_rows=0, chunk_rows=16)
# Skew-guard settings for the skewed panel: only the machine holding a third of the rows
# is above the threshold (from sf0.01 on); it is cut into chunks of 4096 rows.
SKEW_GUARD = dict(hot_key_min_rows=5_000, chunk_rows=4_096)


ROW_ID = ["atm_id", "date", "holiday_name"]


# ----------------------------------------------------------------------------- S1/S2/S5
PART_TYPES = ("click", "view")


def _parts(spark, sf) -> list[DataFrame]:
    ev = tv.table(spark, sf, "events")
    base = ev.select(
        F.concat(F.lit("ATM_"), F.col("user_id").cast("string")).alias("atm_id"),
        F.to_date("ts").alias("date"), F.col("value").alias("dispense"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("state"),
        "event_type")
    p1 = base.where(F.col("event_type") == "click").select("atm_id", "date", "dispense", "state")
    p2 = base.where(F.col("event_type") == "view").select("date", "dispense", "atm_id")
    p3 = base.where(~F.col("event_type").isin(*PART_TYPES) | F.col("event_type").isNull()) \
        .select("state", "atm_id", "event_type", "dispense", "date")
    return [p1, p2, p3]


def q_ingest_union_parts(spark, sf):
    return union_parts(_parts(spark, sf), part_col="part")


def q_ingest_counts(spark, sf):
    return ingest_counts(union_parts(_parts(spark, sf), part_col="part"), "part")


def q_parquet_round_trip(spark, sf):
    path = scratch_path(spark, "round-trip")
    write_parquet(_dense(spark, sf), path)
    return spark.read.parquet(path)


# ----------------------------------------------------------------------------- C*
def q_coerce_numeric(spark, sf):
    d = tv.tx_dirty(spark, sf)
    return d.select("event_id", F.col("dispense").alias("dispense_raw"), to_number(d, "dispense").alias("dispense"))


def q_coerce_date(spark, sf):
    d = tv.tx_dirty(spark, sf)
    return d.select("event_id", F.col("date").alias("date_raw"), to_date_lenient(d, "date").alias("date"))


def q_normalize_state(spark, sf):
    d = tv.tx_dirty(spark, sf)
    return d.select("event_id", F.col("state").alias("state_raw"), normalize_key(F.col("state")).alias("state"))


def q_coerce_percent(spark, sf):
    m = tv.metadata(spark, sf)
    return m.select("atm_id", to_percent_number(m, "uptime_pct").alias("uptime_pct"),
                    to_percent_number(m, "downtime_pct").alias("downtime_pct"))


def q_dirty_pipeline(spark, sf):
    """C1/C3/C5 feeding the full v1 chain: text input, all rows kept until C8."""
    d = tv.tx_dirty(spark, sf).drop("event_id")
    clean = prepare_transactions(d, V1)
    hols = tv.holidays_for(clean)
    cleaned = feature_dataset(d, hols, V1)
    return cleaned.select(*ROW_ID, "state", "dispense", "dispense_lag_7", "dispense_roll_mean_14", "is_long_weekend")


def q_categorical_codes(spark, sf):
    """Category code = rank of the value among the column's sorted distinct values."""
    return category_codes(_cleaned(spark, sf), ["atm_id", "state", "holiday_name", "holiday_type"])


def q_categorical_codes_missing(spark, sf):
    """C9 on a panel where every machine of one state has lost its state."""
    states = F.when(F.col("state") != "NATION_3", F.col("state"))
    return category_codes(_dense(spark, sf).withColumn("state", states), ["atm_id", "state"])


# ----------------------------------------------------------------------------- P*
def q_calendar_parts(spark, sf):
    t = _dense(spark, sf)
    c = calendar_columns("date")
    return t.select("atm_id", "date", *[c[k].alias(k) for k in
                                        ("day_of_week", "day_of_month", "month", "is_friday", "is_weekend")])


def q_salary_flags(spark, sf):
    t = _dense(spark, sf)
    c = calendar_columns("date")
    return t.select("atm_id", "date", *[c[k].alias(k) for k in
                                        ("is_salary_week", "is_monthend_salary", "is_salary_period")])


def q_compound_flags(spark, sf):
    return _features(spark, sf).select(*ROW_ID, "is_salary_friday", "is_salary_weekend",
                                       "is_salary_weekend_holiday", "is_salary_long_weekend")


# ----------------------------------------------------------------------------- H*
def _holidays(spark, sf):
    return tv.holidays_for(_dense(spark, sf))


def q_holiday_distinct(spark, sf):
    return hol.distinct_holidays(_holidays(spark, sf))


def q_classify_holiday(spark, sf):
    h = hol.distinct_holidays(_holidays(spark, sf))
    return h.select("date", "state", "holiday_name", holiday_type(F.col("holiday_name")).alias("holiday_type"))


def q_major_festival(spark, sf):
    h = hol.distinct_holidays(_holidays(spark, sf))
    return h.select("date", "state", "holiday_name", is_major_festival(F.col("holiday_name")).alias("is_major_festival"))


def q_holiday_dim(spark, sf):
    return hol.holiday_dimension(_holidays(spark, sf), V1)


def q_holiday_calendar(spark, sf):
    return hol.holiday_calendar(tv.calendar_for(_dense(spark, sf)), 2024)


def q_country_holiday_join(spark, sf):
    t = _dense(spark, sf)
    j = hol.join_country_calendar(prepare_transactions(t, DENSE_V0.with_(use_metadata=False)),
                                  tv.calendar_for(t), DENSE_V0)
    return j.select("atm_id", "date", "state", "dispense", "is_holiday", "holiday_name")


# ----------------------------------------------------------------------------- J*
def _joined(spark, sf, cfg):
    t = _dense(spark, sf)
    dim = hol.holiday_dimension(tv.holidays_for(t), cfg)
    return hol.join_holidays(prepare_transactions(t, cfg), dim, cfg)


JOIN_COLS = ["atm_id", "date", "state", "dispense", "holiday_name", "holiday_type", "is_holiday", "is_major_festival"]


def q_holiday_join_state(spark, sf):
    return _joined(spark, sf, V1).select(*JOIN_COLS)


def q_holiday_join_date(spark, sf):
    return _joined(spark, sf, V2).select(*JOIN_COLS)


ONE_PER_DAY = V1.with_(one_holiday_per_day=True)


def q_holiday_join_one_per_day(spark, sf):
    """The join with one row of the dimension for each date and state: no fan-out."""
    return _joined(spark, sf, ONE_PER_DAY).select(*JOIN_COLS)


def q_features_one_holiday_per_day(spark, sf):
    return ds.feature_projection(_cleaned(spark, sf, ONE_PER_DAY), ONE_PER_DAY)


def q_atm_metadata_join(spark, sf):
    t = _dense(spark, sf)
    j = prepare_transactions(t, V0, tv.metadata(spark, sf))
    j = panel.drop_invalid_rows(meta.fill_unknown(j), V0)
    return j.select("atm_id", "date", "dispense", "location_type", "city_tier", "uptime_pct", "downtime_pct")


# ----------------------------------------------------------------------------- A*
def q_active_atms(spark, sf):
    t = prepare_transactions(tv.tx_inactive(spark, sf), V1)
    return panel.drop_inactive(t, V1.broadcast_max_rows).select("atm_id", "date", "dispense")


def q_removed_atm_count(spark, sf):
    return panel.removed_atm_count(prepare_transactions(tv.tx_inactive(spark, sf), V1))


def q_features_inactive(spark, sf):
    return _cleaned(spark, sf, V1, "inactive").select(*ROW_ID, "dispense", "dispense_lag_7", "dispense_roll_mean_14")


# ----------------------------------------------------------------------------- W*
def q_pre_holiday_flag(spark, sf):
    return _features(spark, sf).select(*ROW_ID, "is_holiday", "is_pre_holiday")


def q_off_day_blocks(spark, sf):
    return _off_day_blocks(_joined(spark, sf, V1), V1)


def _off_day_blocks(joined, cfg):
    blocks = guarded(joined.withColumns(calendar_columns("date")), cfg, panel.off_day_blocks, skew.chunked_off_day_blocks)
    return blocks.select(*ROW_ID, "is_off_day", "off_block_id", "off_block_length")


def q_off_day_blocks_hot_chunks(spark, sf):
    """Every machine on the chunked plan."""
    return _off_day_blocks(_joined(spark, sf, V1), V1.with_(**ALL_HOT))


def q_long_weekend(spark, sf):
    return _features(spark, sf).select(*ROW_ID, "is_weekend", "is_holiday", "is_long_weekend")


def q_lag_features(spark, sf):
    return _features(spark, sf, V1, "nulls").select(*ROW_ID, "dispense", "dispense_lag_1", "dispense_lag_2",
                                                    "dispense_lag_7")


def q_rolling_mean_7(spark, sf):
    return _features(spark, sf, V1, "nulls").select(*ROW_ID, "dispense_roll_mean_7")


def q_rolling_mean_14_min11(spark, sf):
    return _features(spark, sf, V1, "nulls").select(*ROW_ID, "dispense_roll_mean_14")


def q_rolling_mean_14_strict(spark, sf):
    return _features(spark, sf, V2, "nulls").select(*ROW_ID, "dispense_roll_mean_14")


def q_drop_invalid_rows(spark, sf):
    return _features(spark, sf, V1, "nulls").select(*ROW_ID, "dispense")


def q_horizon_targets(spark, sf):
    return _horizon_targets(_features(spark, sf, V1, "nulls"), V1)


def _horizon_targets(features, cfg):
    t = guarded(features, cfg, panel.add_targets, skew.chunked_targets)
    return t.select(*ROW_ID, *[tg for _, tg, _ in HORIZONS])


def q_horizon_targets_hot_chunks(spark, sf):
    """Every machine on the chunked plan."""
    return _horizon_targets(_features(spark, sf, V1, "nulls"), V1.with_(**ALL_HOT))


def q_feature_table_hot_chunks(spark, sf):
    """The feature table with every machine on the chunked (skew-guard) plan."""
    cfg = V1.with_(**ALL_HOT)
    return ds.feature_projection(_cleaned(spark, sf, cfg, "nulls"), cfg)


def q_feature_table_skewed(spark, sf):
    cfg = V1.with_(**SKEW_GUARD)
    return ds.feature_projection(_cleaned(spark, sf, cfg, "skewed"), cfg)


def q_latest_per_atm_skewed(spark, sf):
    cfg = V1.with_(**SKEW_GUARD)
    return panel.latest_per_atm(_cleaned(spark, sf, cfg, "skewed").select(*_latest_cols()))


def q_latest_per_atm_long_hot_chunks(spark, sf):
    cfg = V1.with_(**ALL_HOT)
    return panel.latest_per_atm(_cleaned(spark, sf, cfg, "long").select(*_latest_cols()))


def q_eligible_rows(spark, sf):
    return _cleaned(spark, sf, V1, "nulls").select(*ROW_ID, "dispense_lag_7", "dispense_roll_mean_14")


def _latest_cols():
    return ["atm_id", "date", "state", "dispense", "holiday_name", "is_salary_period", "is_long_weekend",
            "dispense_lag_1", "dispense_lag_7", "dispense_roll_mean_7", "dispense_roll_mean_14"]


def q_latest_per_atm(spark, sf):
    return panel.latest_per_atm(_cleaned(spark, sf).select(*_latest_cols()))


def q_latest_per_atm_long(spark, sf):
    return panel.latest_per_atm(_cleaned(spark, sf, V1, "long").select(*_latest_cols()))


# ----------------------------------------------------------------------------- D*
def q_time_split(spark, sf):
    return ds.time_split(_cleaned(spark, sf), V1).select(*ROW_ID, "split_date", "is_val")


def q_split_diagnostics(spark, sf):
    return ds.split_diagnostics(ds.time_split(_cleaned(spark, sf), V1), V1)


def q_horizon_training_sets(spark, sf):
    return ds.horizon_training_sets(ds.time_split(_cleaned(spark, sf), V1), V1, ROW_ID)


def q_feature_table(spark, sf):
    return ds.feature_projection(_cleaned(spark, sf), V1)


def q_feature_table_stored(spark, sf):
    """The panel stored in buckets of the machine id; features from the stored table."""
    path = scratch_path(spark, "panel")
    table = "panel_" + path.rsplit("-", 1)[1]
    write_panel(_dense(spark, sf), table, path)
    tx = read_panel(spark, table)
    return ds.feature_projection(feature_dataset(tx, tv.holidays_for(tx), V1), V1)


def q_features_v0(spark, sf):
    return ds.feature_projection(_cleaned(spark, sf, DENSE_V0), DENSE_V0)


def q_features_v2(spark, sf):
    return ds.feature_projection(_cleaned(spark, sf, V2), V2)


# ----------------------------------------------------------------------------- M8, R*, S8-S10
def q_postprocess_predictions(spark, sf):
    c = _cleaned(spark, sf)
    raw = (F.col("dispense_lag_1") - F.col("dispense_lag_2")) / 2
    return c.select(*ROW_ID, raw.alias("p_raw"), postprocess_prediction(raw, True).alias("predicted_clipped"),
                    postprocess_prediction(raw, False).alias("predicted_unclipped"))


def _stand_in_wide(spark, sf) -> DataFrame:
    latest = panel.latest_per_atm(_cleaned(spark, sf))
    stand_in = {"Next_Day": "dispense_roll_mean_14", "Next_3_Days": "dispense_roll_mean_7", "Next_Week": "dispense_lag_7"}
    return latest.withColumns({f"predicted_dispense_{k}": postprocess_prediction(F.col(v), True)
                               for k, v in stand_in.items()})


REPORT_COLS = ["horizon", "atm_id", "reference_date", "is_salary_period", "is_long_weekend", "holiday_name",
               "predicted_dispense_amount", "forecast_date", "forecast_for_date"]


def q_report_long(spark, sf):
    return report_long(_stand_in_wide(spark, sf), V1).select(*REPORT_COLS)


def q_forecast_dates(spark, sf):
    return report_long(_stand_in_wide(spark, sf), V1).select("horizon", "forecast_date", "forecast_for_date").distinct()


def q_report_parts(spark, sf):
    r = sheet_names(report_long(_stand_in_wide(spark, sf), V1), V1, REPORT_SHEET_ROWS)
    return r.select("horizon", "atm_id", "part", "sheet")


def q_report_parts_v2(spark, sf):
    cfg = V1.with_(sheet_style="label")
    r = sheet_names(report_long(_stand_in_wide(spark, sf), cfg), cfg, REPORT_SHEET_ROWS)
    return r.select("horizon", "atm_id", "part", "sheet")


def q_report_sink_round_trip(spark, sf):
    r = sheet_names(report_long(_stand_in_wide(spark, sf), V1), V1, REPORT_SHEET_ROWS).select(*REPORT_COLS, "sheet")
    path = scratch_path(spark, "report")
    write_report(r, path, max_rows_per_file=REPORT_SHEET_ROWS)
    back = spark.read.option("basePath", path).parquet(path)
    return back.select(*REPORT_COLS, F.col("sheet").cast("string").alias("sheet"))


def q_report_dated_sink(spark, sf):
    """A second forecast date beside the first, then the first written again with other sheets."""
    wide = cut_lineage(_stand_in_wide(spark, sf))  # the three reports read the same rows
    last = ds.last_date(wide)
    path = scratch_path(spark, "report")
    for days, rows, more in ((0, REPORT_SHEET_ROWS // 2, 7), (7, REPORT_SHEET_ROWS, 1), (0, REPORT_SHEET_ROWS, 0)):
        r = report_long(wide, V1, last).withColumns({"forecast_date": F.date_add("forecast_date", days), "predicted_dispense_amount": F.col("predicted_dispense_amount") + more})
        write_report(sheet_names(r, V1, rows).select("horizon", "atm_id", "predicted_dispense_amount", "forecast_date", "sheet"), path, max_rows_per_file=rows)
    return spark.read.parquet(path).select("horizon", "atm_id", "predicted_dispense_amount", "forecast_date", "sheet")


# ----------------------------------------------------------------------------- M2, M4-M7
def q_horizon_runs(spark, sf):
    from tillcast.plans.forecast import horizon_runs
    return horizon_runs(ds.time_split(_cleaned(spark, sf), V1), V1)


def q_target_encodings(spark, sf):
    """M6: the smoothed target means of the machine id and the holiday name, by horizon target."""
    from tillcast.plans.forecast import fit_target_encodings
    train = ds.time_split(_cleaned(spark, sf), V1).where(~F.col("is_val"))
    targets = [t for _, t, _ in HORIZONS]
    tables, _, _ = fit_target_encodings(train, ["atm_id", "holiday_name"], targets, V1.encoding_smoothing, V1.broadcast_max_rows)
    rows = [t.select(F.lit(c).alias("column_name"), F.col(f"_k_{c}").alias("value"),
                     *[F.col(f"_enc_{c}_{tg}").alias(tg) for tg in targets]) for c, t in tables.items()]
    return rows[0].unionByName(rows[1])


def q_target_encodings_folds(spark, sf):
    """M6 out of fold: the encodings that every training and validation row gets."""
    from tillcast.plans import forecast as fc
    split = ds.time_split(_cleaned(spark, sf), V1).withColumn("_fold", fc.encoding_fold(V1.encoding_folds, F.col("is_val")))
    targets = [t for _, t, _ in HORIZONS]
    tables, mu, _ = fc.fit_target_encodings_by_fold(split.where(~F.col("is_val")), ENCODED, targets, V1.encoding_smoothing, V1.broadcast_max_rows)
    rows = fc.apply_encodings_by_fold(split, tables, mu)
    return rows.select(*ROW_ID, F.col("_fold").alias("fold"), *[F.col(f"_enc_{c}_{t}").alias(f"{c}_{t}") for c in ENCODED for t in targets])


ENCODED = ["atm_id", "holiday_name"]
# Inputs of the node table below: a split at the mean for each, and one by category.
NODE_INPUTS = ("dispense_lag_1", "dispense_lag_7", "dispense_roll_mean_14")
WORK_DAYS = [0.0, 1.0, 2.0, 3.0]


def q_tree_scores(spark, sf):
    """M7: rows scored by a node table, for three values of k. The trees are grown from the rows
    themselves: each splits at the (rounded) mean of one input, the third one also by weekday below its
    left side, and has the (rounded) means of the target as leaves."""
    from tillcast.operators.boosting import NODE_SCHEMA, score
    rows = cut_lineage(_cleaned(spark, sf).where(F.col("target_1day").isNotNull()).select(*ROW_ID, "day_of_week", *NODE_INPUTS, F.col("target_1day").cast("double").alias("y")))
    cut = rows.agg(*[F.round(F.avg(c), 2).alias(c) for c in NODE_INPUTS]).first()
    nodes = []
    for t, c in enumerate(NODE_INPUTS):
        low, work = F.col(c) <= F.lit(cut[c]), F.col("day_of_week").isin([int(d) for d in WORK_DAYS])
        leaves = [low, ~low] if t < 2 else [low & work, low & ~work, ~low]
        m = rows.agg(*[F.round(F.avg(F.when(x, F.col("y"))) * 0.25, 2) for x in leaves]).first()
        split = (t, 0, t, cut[c], None, 1, 2 if t < 2 else 4, None)
        below = [(t, 1, 3, None, WORK_DAYS, 2, 3, None)] if t == 2 else []
        at = [1, 2] if t < 2 else [2, 3, 4]
        nodes += [split, *below, *[(t, n, None, None, None, None, None, v) for n, v in zip(at, m)]]
    nodes = spark.createDataFrame(nodes, NODE_SCHEMA)
    x = F.array(*[F.col(c).cast("double") for c in (*NODE_INPUTS, "day_of_week")])
    return rows.select(*ROW_ID, *[score(nodes.where(F.col("tree") < k), x, 100.0).alias(f"score_{k}") for k in (1, 2, 3)])


# ----------------------------------------------------------------------------- M1-M7 (rows only)
MODEL_CFG = V1


def q_forecast_gbt(spark, sf):
    from tillcast.plans.forecast import train_and_forecast
    cleaned = _cleaned(spark, sf)
    wide, _ = train_and_forecast(cleaned, MODEL_CFG)
    return wide.select("atm_id", "date", *[c for c in wide.columns if c.startswith("predicted_dispense_")])


def q_forecast_report(spark, sf):
    from tillcast.plans.forecast import train_and_forecast
    wide, run = train_and_forecast(_cleaned(spark, sf), MODEL_CFG)
    return sheet_names(report_long(wide, MODEL_CFG, run.max_date), MODEL_CFG).select(*REPORT_COLS, "sheet")


# ============================================================================ registry
def _sel(cols: list[str], src: str = "cleaned", where: str = "") -> str:
    return f"SELECT {', '.join(cols)} FROM {src}{(' WHERE ' + where) if where else ''}"


ROW_ID_SQL = ["atm_id", "date", "holiday_name"]
LATEST_SQL = ("SELECT atm_id, date, state, dispense, holiday_name, is_salary_period, is_long_weekend, "
              "dispense_lag_1, dispense_lag_7, dispense_roll_mean_7, dispense_roll_mean_14 FROM cleaned "
              f"QUALIFY row_number() OVER ({O.W_LAST}) = 1")


def _v1_features_proj() -> str:
    cols = ["date", *V1.features, *[t for _, t, _ in HORIZONS]]
    return _sel(list(dict.fromkeys(cols)))


def _oracles() -> dict[str, str]:
    fq = O.feature_query
    parts = f"""WITH base AS (SELECT concat('ATM_', user_id) AS atm_id, CAST(ts AS DATE) AS date, value AS dispense,
    concat('NATION_', user_id % 25) AS state, event_type FROM events),
  u AS (SELECT 1 AS part, atm_id, date, dispense, state, CAST(NULL AS VARCHAR) AS event_type FROM base WHERE event_type = 'click'
    UNION ALL SELECT 2, atm_id, date, dispense, NULL, NULL FROM base WHERE event_type = 'view'
    UNION ALL SELECT 3, atm_id, date, dispense, state, event_type FROM base
      WHERE event_type NOT IN ('click', 'view') OR event_type IS NULL)"""
    dirty = f"WITH d AS ({O.TX_DIRTY}) "
    hol_base = f"WITH tx_dense AS ({O.TX_DENSE}), h AS ({O.holidays_sql('tx_dense')}) "
    hd = ", hd AS (SELECT DISTINCT * FROM h) "
    report_base, report_ctes = O.dense("v1")
    def rep(sel: str, extra: list[str] = ()) -> str:
        return O.with_ctes(report_base, report_ctes + O.stand_in_report_ctes() + list(extra), sel)
    parts_sql = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY atm_id) AS rn,
  count(*) OVER (PARTITION BY horizon) AS n FROM report)"""
    sheet_rows = REPORT_SHEET_ROWS
    part_expr = f"CAST((rn - 1) // {sheet_rows} + 1 AS BIGINT)"
    return {
        "ingest_union_parts": parts + " SELECT atm_id, date, dispense, state, part, event_type FROM u",
        "ingest_counts": parts + " SELECT count(DISTINCT part) AS n_parts, count(*) AS n_rows FROM u",
        "parquet_round_trip": O.TX_DENSE,
        "coerce_numeric": dirty + f"SELECT event_id, dispense AS dispense_raw, {O.num_sql('dispense')} AS dispense FROM d",
        "coerce_date": dirty + "SELECT event_id, date AS date_raw, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date FROM d",
        "normalize_state": dirty + f"SELECT event_id, state AS state_raw, {O.norm_sql('state')} AS state FROM d",
        "coerce_percent": f"WITH m AS ({O.METADATA}) SELECT atm_id, {O.num_sql("replace(uptime_pct, '%', '')")} AS uptime_pct, "
                          f"{O.num_sql("replace(downtime_pct, '%', '')")} AS downtime_pct FROM m",
        "dirty_pipeline": _dirty_pipeline_sql(),
        "categorical_codes": fq("""SELECT column_name, value,
  CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INT) AS code FROM (
  SELECT DISTINCT 'atm_id' AS column_name, atm_id AS value FROM cleaned
  UNION SELECT 'state', state FROM cleaned UNION SELECT 'holiday_name', holiday_name FROM cleaned
  UNION SELECT 'holiday_type', holiday_type FROM cleaned) v WHERE value IS NOT NULL"""),
        "categorical_codes_missing": f"""WITH t AS ({O.TX_DENSE}) SELECT column_name, value,
  CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INT) AS code FROM (
  SELECT DISTINCT 'atm_id' AS column_name, atm_id AS value FROM t
  UNION SELECT 'state', state FROM t WHERE state <> 'NATION_3') v""",
        "calendar_parts": f"WITH t AS ({O.TX_DENSE}) SELECT atm_id, date, CAST(isodow(date) - 1 AS INT) AS day_of_week, "
                          f"CAST(day(date) AS INT) AS day_of_month, CAST(month(date) AS INT) AS month, "
                          f"{O.flag('isodow(date) = 5')} AS is_friday, {O.flag('isodow(date) IN (6, 7)')} AS is_weekend FROM t",
        "salary_flags": f"WITH t AS ({O.TX_DENSE}) SELECT atm_id, date, {O.flag('day(date) BETWEEN 1 AND 7')} AS is_salary_week, "
                        f"{O.flag('day(date) BETWEEN 28 AND 31')} AS is_monthend_salary, "
                        f"{O.flag('day(date) BETWEEN 1 AND 7 OR day(date) BETWEEN 28 AND 31')} AS is_salary_period FROM t",
        "compound_flags": fq(_sel(ROW_ID_SQL + ["is_salary_friday", "is_salary_weekend", "is_salary_weekend_holiday",
                                                "is_salary_long_weekend"], "valid")),
        "holiday_distinct": hol_base + hd + "SELECT date, state, holiday_name FROM hd",
        "classify_holiday": hol_base + hd + f"SELECT date, state, holiday_name, {O.holiday_type_sql('holiday_name')} AS holiday_type FROM hd",
        "major_festival": hol_base + hd + f"SELECT date, state, holiday_name, {O.major_sql('holiday_name')} AS is_major_festival FROM hd",
        "holiday_dim": hol_base + f"SELECT DISTINCT date, {O.norm_sql('state')} AS state, holiday_name, "
                                  f"{O.holiday_type_sql('holiday_name')} AS holiday_type, 1 AS is_holiday, "
                                  f"{O.major_sql('holiday_name')} AS is_major_festival FROM h",
        "holiday_calendar": f"WITH tx_dense AS ({O.TX_DENSE}), c AS ({O.calendar_sql('tx_dense')}) "
                            "SELECT date, string_agg(DISTINCT holiday_name, '; ' ORDER BY holiday_name) AS holiday_name "
                            "FROM c WHERE year(date) = 2024 GROUP BY date",
        "country_holiday_join": f"WITH tx_dense AS ({O.TX_DENSE}), c AS ({O.calendar_sql('tx_dense')}), "
                                "hd AS (SELECT date AS h_date, string_agg(DISTINCT holiday_name, '; ' ORDER BY holiday_name) AS h_name "
                                "FROM c WHERE year(date) IN (2024) GROUP BY date) "
                                "SELECT t.atm_id, t.date, t.state, CAST(t.dispense AS DOUBLE) AS dispense, "
                                "CAST(CASE WHEN hd.h_date IS NULL THEN 0 ELSE 1 END AS INT) AS is_holiday, "
                                "coalesce(hd.h_name, 'Regular Day') AS holiday_name "
                                "FROM tx_dense t LEFT JOIN hd ON t.date IS NOT DISTINCT FROM hd.h_date",
        "holiday_join_state": fq(_sel(JOIN_COLS, "joined")),
        "holiday_join_date": fq(_sel(JOIN_COLS, "joined"), preset="v2"),
        "atm_metadata_join": O.with_ctes({"tx_dense": O.TX_DENSE, "metadata": O.METADATA},
                                         O.feature_ctes("v0", "tx_dense", calendar="x", metadata="metadata")[:3],
                                         "SELECT atm_id, date, dispense, coalesce(location_type, 'Unknown') AS location_type, "
                                         "coalesce(city_tier, 'Unknown') AS city_tier, uptime_pct, downtime_pct FROM prep "
                                         "WHERE atm_id IS NOT NULL AND date IS NOT NULL AND dispense IS NOT NULL "
                                         "AND uptime_pct IS NOT NULL AND downtime_pct IS NOT NULL"),
        "active_atms": fq("SELECT atm_id, date, dispense FROM active", tx="tx_inactive"),
        "removed_atm_count": fq("SELECT count(*) AS removed_atms FROM (SELECT atm_id FROM prep WHERE atm_id IS NOT NULL "
                                "GROUP BY atm_id HAVING coalesce(sum(dispense), 0) = 0)", tx="tx_inactive"),
        "features_inactive": fq(_sel(ROW_ID_SQL + ["dispense", "dispense_lag_7", "dispense_roll_mean_14"]), tx="tx_inactive"),
        "pre_holiday_flag": fq(_sel(ROW_ID_SQL + ["is_holiday", "is_pre_holiday"], "valid")),
        "off_day_blocks": fq(f"""SELECT atm_id, date, holiday_name, off AS is_off_day, CAST(blk AS BIGINT) AS off_block_id,
  blk_len AS off_block_length FROM w4"""),
        "off_day_blocks_hot_chunks": fq(f"""SELECT atm_id, date, holiday_name, off AS is_off_day, CAST(blk AS BIGINT) AS off_block_id,
  blk_len AS off_block_length FROM w4"""),
        "horizon_targets_hot_chunks": fq(_sel(ROW_ID_SQL + ["target_1day", "target_3day", "target_7day"], "tgt"), tx="tx_nulls"),
        "long_weekend": fq(_sel(ROW_ID_SQL + ["is_weekend", "is_holiday", "is_long_weekend"], "valid")),
        "lag_features": fq(_sel(ROW_ID_SQL + ["dispense", "dispense_lag_1", "dispense_lag_2", "dispense_lag_7"], "valid"),
                           tx="tx_nulls"),
        "rolling_mean_7": fq(_sel(ROW_ID_SQL + ["dispense_roll_mean_7"], "valid"), tx="tx_nulls"),
        "rolling_mean_14_min11": fq(_sel(ROW_ID_SQL + ["dispense_roll_mean_14"], "valid"), tx="tx_nulls"),
        "rolling_mean_14_strict": fq(_sel(ROW_ID_SQL + ["dispense_roll_mean_14"], "valid"), preset="v2", tx="tx_nulls"),
        "drop_invalid_rows": fq(_sel(ROW_ID_SQL + ["dispense"], "valid"), tx="tx_nulls"),
        "horizon_targets": fq(_sel(ROW_ID_SQL + ["target_1day", "target_3day", "target_7day"], "tgt"), tx="tx_nulls"),
        "eligible_rows": fq(_sel(ROW_ID_SQL + ["dispense_lag_7", "dispense_roll_mean_14"]), tx="tx_nulls"),
        "latest_per_atm": fq(LATEST_SQL),
        "latest_per_atm_long": fq(LATEST_SQL, tx="tx_long"),
        "horizon_runs": fq("SELECT horizon, target, train_rows, val_rows, val_rows > 100 AS early_stopping, train_rows = 0 AS skipped FROM (" + " UNION ALL ".join(
            f"SELECT '{label}' AS horizon, '{t}' AS target, count({t}) FILTER (NOT is_val) AS train_rows, count({t}) FILTER (is_val) AS val_rows FROM split"
            for label, t, _ in HORIZONS) + ") x"),
        "target_encodings": fq(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, " + ", ".join(
                f"(CAST(coalesce(sum({t}), 0) AS DOUBLE) + 20.0::DOUBLE * (SELECT CAST(sum({t}) AS DOUBLE) / count({t}) FROM split WHERE NOT is_val)) / (count({t}) + 20.0::DOUBLE) AS {t}"
                for _, t, _ in HORIZONS) + f" FROM split WHERE NOT is_val GROUP BY {c}" for c in ("atm_id", "holiday_name"))),
        "target_encodings_folds": fq(_encodings_by_fold_sql()),
        "tree_scores": fq(_tree_scores_sql()),
        "holiday_join_one_per_day": _one_per_day_sql(_sel(JOIN_COLS, "joined")),
        "features_one_holiday_per_day": _one_per_day_sql(_v1_features_proj()),
        "feature_table_stored": fq(_v1_features_proj()),
        "report_dated_sink": rep(f"""SELECT horizon, atm_id, predicted_dispense_amount + more AS predicted_dispense_amount,
  CAST(forecast_date + days AS DATE) AS forecast_date, CASE WHEN n <= {sheet_rows} THEN strftime(forecast_date + days, '%d-%b-%Y')
       ELSE left(strftime(forecast_date + days, '%d-%b-%Y') || '_P' || CAST({part_expr} AS VARCHAR), 31) END AS sheet
  FROM ranked, (VALUES (0, 0), (7, 1)) v(days, more)""", [parts_sql]),
        "time_split": fq(_sel(ROW_ID_SQL + ["split_date", "is_val"], "split")),
        "split_diagnostics": fq("""SELECT count(*) AS n_rows, count(target_1day) AS n_target_1day,
  count(target_3day) AS n_target_3day, count(target_7day) AS n_target_7day,
  coalesce(CASE WHEN is_val THEN 'validation' ELSE 'train' END, 'cleaned') AS split
  FROM split GROUP BY ROLLUP (CASE WHEN is_val THEN 'validation' ELSE 'train' END)"""),
        "horizon_training_sets": fq(" UNION ALL ".join(
            f"SELECT '{label}' AS horizon, is_val, atm_id, date, holiday_name, {t} AS target FROM split WHERE {t} IS NOT NULL"
            for label, t, _ in HORIZONS)),
        "feature_table": fq(_v1_features_proj()),
        "feature_table_hot_chunks": fq(_v1_features_proj(), tx="tx_nulls"),
        "latest_per_atm_long_hot_chunks": fq(LATEST_SQL, tx="tx_long"),
        "feature_table_skewed": fq(_v1_features_proj(), tx="tx_skewed"),
        "latest_per_atm_skewed": fq(LATEST_SQL, tx="tx_skewed"),
        "features_v0": fq(_sel(list(dict.fromkeys(["date", *V0.features, *[t for _, t, _ in HORIZONS]]))), preset="v0"),
        "features_v2": fq(_sel(list(dict.fromkeys(["date", *V2.features, *[t for _, t, _ in HORIZONS]]))), preset="v2"),
        "postprocess_predictions": fq("""SELECT atm_id, date, holiday_name, (dispense_lag_1 - dispense_lag_2) / 2 AS p_raw,
  round_even(CASE WHEN (dispense_lag_1 - dispense_lag_2) / 2 < 0 THEN 0.0 ELSE (dispense_lag_1 - dispense_lag_2) / 2 END, 0) AS predicted_clipped,
  round_even((dispense_lag_1 - dispense_lag_2) / 2, 0) AS predicted_unclipped FROM cleaned"""),
        "report_long": rep("SELECT " + ", ".join(REPORT_COLS) + " FROM report"),
        "forecast_dates": rep("SELECT DISTINCT horizon, forecast_date, forecast_for_date FROM report"),
        "report_parts": rep(f"""SELECT horizon, atm_id, {part_expr} AS part,
  CASE WHEN n <= {sheet_rows} THEN strftime(forecast_date, '%d-%b-%Y')
       ELSE left(strftime(forecast_date, '%d-%b-%Y') || '_P' || CAST({part_expr} AS VARCHAR), 31) END AS sheet
  FROM ranked""", [parts_sql]),
        "report_parts_v2": rep(f"""SELECT horizon, atm_id, {part_expr} AS part,
  CASE WHEN n <= {sheet_rows} THEN horizon ELSE horizon || '_Part_' || CAST({part_expr} AS VARCHAR) END AS sheet
  FROM ranked""", [parts_sql]),
        "report_sink_round_trip": rep(f"""SELECT {", ".join(REPORT_COLS)},
  CASE WHEN n <= {sheet_rows} THEN strftime(forecast_date, '%d-%b-%Y')
       ELSE left(strftime(forecast_date, '%d-%b-%Y') || '_P' || CAST({part_expr} AS VARCHAR), 31) END AS sheet
  FROM ranked""", [parts_sql]),
    }


def _encodings_by_fold_sql() -> str:
    targets = [t for _, t, _ in HORIZONS]
    sums = lambda over: ", ".join(f"coalesce(sum({t}) {over}, 0)::DOUBLE AS s_{t}, count({t}) {over} AS n_{t}" for t in targets)
    ctes = [f"f AS (SELECT *, CASE WHEN is_val THEN -1 ELSE (('0x' || substr(md5(concat_ws('|', atm_id, CAST(date AS VARCHAR))), 1, 8))::BIGINT % {V1.encoding_folds})::INT END AS fold FROM split)",
            "tr AS (SELECT * FROM f WHERE fold >= 0)", f"g AS (SELECT {sums('')} FROM tr)", f"gf AS (SELECT fold, {sums('')} FROM tr GROUP BY fold)"]
    joins, cols = "LEFT JOIN gf ON f.fold = gf.fold CROSS JOIN g", []
    for c in ENCODED:
        ctes += [f"a_{c} AS (SELECT {c} AS v, {sums('')} FROM tr GROUP BY {c})", f"b_{c} AS (SELECT {c} AS v, fold, {sums('')} FROM tr GROUP BY {c}, fold)"]
        joins += f" LEFT JOIN a_{c} ON f.{c} IS NOT DISTINCT FROM a_{c}.v LEFT JOIN b_{c} ON f.{c} IS NOT DISTINCT FROM b_{c}.v AND f.fold = b_{c}.fold"
        for t in targets:
            rest = f"CASE WHEN g.n_{t} - gf.n_{t} > 0 THEN (g.s_{t} - gf.s_{t}) / (g.n_{t} - gf.n_{t}) ELSE 0 END"
            cols.append(f"CASE WHEN f.fold < 0 THEN coalesce((a_{c}.s_{t} + 20.0::DOUBLE * (g.s_{t} / g.n_{t})) / (a_{c}.n_{t} + 20.0::DOUBLE), g.s_{t} / g.n_{t}) "
                        f"ELSE (a_{c}.s_{t} - b_{c}.s_{t} + 20.0::DOUBLE * ({rest})) / (a_{c}.n_{t} - b_{c}.n_{t} + 20.0::DOUBLE) END AS {c}_{t}")
    return f"SELECT * FROM (WITH {', '.join(ctes)} SELECT {', '.join('f.' + c for c in ROW_ID_SQL)}, f.fold, {', '.join(cols)} FROM f {joins}) z"


def _tree_scores_sql() -> str:
    cut = ", ".join(f"round(avg({c}), 2) AS cut_{c}" for c in NODE_INPUTS)
    a, b, c = (f"{x} <= cut_{x}" for x in NODE_INPUTS)
    work = "day_of_week IN (0, 1, 2, 3)"
    leaf = lambda cond: f"(SELECT round(avg(y) FILTER ({cond}) * 0.25::DOUBLE, 2) FROM r, k)"
    t0 = f"CASE WHEN {a} THEN {leaf(a)} ELSE {leaf(f'NOT ({a})')} END"
    t1 = f"CASE WHEN {b} THEN {leaf(b)} ELSE {leaf(f'NOT ({b})')} END"
    t2 = f"CASE WHEN {c} AND {work} THEN {leaf(f'{c} AND {work}')} WHEN {c} THEN {leaf(f'{c} AND NOT {work}')} ELSE {leaf(f'NOT ({c})')} END"
    return (f"SELECT * FROM (WITH r AS (SELECT {', '.join(ROW_ID_SQL)}, day_of_week, {', '.join(NODE_INPUTS)}, target_1day::DOUBLE AS y FROM cleaned WHERE target_1day IS NOT NULL), "
            f"k AS (SELECT {cut} FROM r), t AS (SELECT {', '.join(ROW_ID_SQL)}, {t0} AS t0, {t1} AS t1, {t2} AS t2 FROM r, k) "
            f"SELECT {', '.join(ROW_ID_SQL)}, 100.0::DOUBLE + t0 AS score_1, 100.0::DOUBLE + (t0 + t1) AS score_2, 100.0::DOUBLE + (t0 + t1 + t2) AS score_3 FROM t) z")


def _one_per_day_sql(select: str) -> str:
    first = ("SELECT make_date(year(date), month(date), day(date)) AS date, state, holiday_name FROM (SELECT date, state, holiday_name, "
             f"row_number() OVER (PARTITION BY date, {O.norm_sql('state')} ORDER BY CASE {O.holiday_type_sql('holiday_name')} WHEN 'NATIONAL' THEN 0 WHEN 'FESTIVAL' THEN 1 "
             "WHEN 'BANK' THEN 2 ELSE 3 END, holiday_name NULLS LAST) AS place FROM all_h) WHERE place = 1")
    base = {"tx_dense": O.TX_DENSE, "all_h": O.holidays_sql("tx_dense"), "holidays": first}
    major = (f"major AS (SELECT date, {O.norm_sql('state')} AS state, max({O.major_sql('holiday_name')}) AS m FROM all_h GROUP BY 1, 2)")
    ctes = O.feature_ctes("v1", "tx_dense", holidays="holidays")
    at = next(i for i, x in enumerate(ctes) if x.startswith("joined AS"))
    # the flag is of any holiday of the day, not of the one that names it
    inner = ctes[at].replace("joined AS", "joined_first AS", 1)
    flags = ("joined AS (SELECT j.* REPLACE (CAST(coalesce(m.m, 0) AS INT) AS is_major_festival) FROM joined_first j LEFT JOIN major m ON j.date IS NOT DISTINCT FROM m.date "
             "AND j.state IS NOT DISTINCT FROM m.state)")
    return O.with_ctes(base, ctes[:at] + [inner, major, flags] + ctes[at + 1:], select)


def _dirty_pipeline_sql() -> str:
    base = {"d": O.TX_DIRTY,
            "tx_raw": "SELECT atm_id, date, dispense, state FROM d"}
    pre = (f"tx_c AS (SELECT atm_id, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date, "
           f"{O.num_sql('dispense')} AS dispense, state FROM tx_raw)")
    base["holidays"] = O.holidays_sql(f"(SELECT atm_id, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date, "
                                      f"{O.norm_sql('state')} AS state FROM tx_raw)")
    ctes = O.feature_ctes("v1", "tx_c", holidays="holidays")
    return O.with_ctes(base, [pre] + ctes, _sel(ROW_ID_SQL + ["state", "dispense", "dispense_lag_7",
                                                               "dispense_roll_mean_14", "is_long_weekend"]))


def queries() -> dict[str, Query]:
    """Every ``q_*`` function of this module, keyed without the prefix."""
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return _oracles()
