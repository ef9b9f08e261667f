"""Report shaping (R1-R3) and sheet naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.operators.dataset import last_date
from tillcast.operators.ordinal import with_group_size, with_ordinal
from tillcast.session import cut_lineage

PRED_PREFIX = "predicted_dispense_"
DATE_LABEL = "dd-MMM-yyyy"


def horizon_days(cfg: ForecastConfig) -> Column:
    """Label -> calendar days ahead, as a literal map."""
    pairs = []
    for label, _, k in cfg.horizons:
        pairs += [F.lit(label), F.lit(k)]
    return F.create_map(*pairs)


def report_long(wide: DataFrame, cfg: ForecastConfig, reference_max=None) -> DataFrame:
    """R1 + R2: one row per machine and horizon that has a prediction column.

    R3: the forecast date is the global max reference date + k days for every row,
    also for machines whose own last row is older (as in the reference).
    """
    if reference_max is None:  # not known from the split: materialise, so the chain runs once
        wide = cut_lineage(wide)
        reference_max = last_date(wide)
    pred_cols = [f"{PRED_PREFIX}{label}" for label, _, _ in cfg.horizons if f"{PRED_PREFIX}{label}" in wide.columns]
    ids = ["atm_id", *cfg.report_extra_columns, "date", "is_salary_period", "is_long_weekend", "holiday_name"]
    long = wide.unpivot(ids, pred_cols, "horizon", "predicted_dispense_amount")
    long = long.withColumn("horizon", F.regexp_replace("horizon", f"^{PRED_PREFIX}", ""))
    ref_max = F.lit(reference_max).cast("date")
    long = long.withColumn("forecast_date", F.date_add(ref_max, F.element_at(horizon_days(cfg), F.col("horizon"))))
    long = long.withColumnRenamed("date", cfg.report_date_column)
    if cfg.forecast_date_label:
        long = long.withColumn("forecast_for_date", F.date_format("forecast_date", DATE_LABEL))
    return long


def sheet_names(report: DataFrame, cfg: ForecastConfig, max_rows: int | None = None) -> DataFrame:
    """Split each horizon into parts of at most ``max_rows`` rows in atm_id order.

    Part = (row number - 1) // max + 1; the suffix appears only when the horizon
    overflows. The row number is computed without a single-task window.
    """
    max_rows = max_rows or cfg.max_rows_per_sheet
    numbered = with_ordinal(report, ["horizon"], [F.col("atm_id").asc_nulls_last()], "_rn",
                            broadcast_max_rows=cfg.broadcast_max_rows)
    numbered = with_group_size(numbered, ["horizon"], "_n", cfg.broadcast_max_rows)
    part = F.floor((F.col("_rn") - 1) / F.lit(max_rows)).cast("long") + 1
    if cfg.sheet_style == "date":
        base = F.date_format("forecast_date", DATE_LABEL)
        name = F.when(F.col("_n") <= max_rows, base).otherwise(
            F.substring(F.concat(base, F.lit("_P"), part.cast("string")), 1, 31))
    elif cfg.sheet_style == "label":
        name = F.when(F.col("_n") <= max_rows, F.col("horizon")).otherwise(
            F.concat(F.col("horizon"), F.lit("_Part_"), part.cast("string")))
    else:
        name = F.col("horizon")
    return numbered.withColumns({"part": part, "sheet": name}).drop("_rn", "_n")
