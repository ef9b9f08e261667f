"""Row-based time logic per machine (W0-W9, A1, A2): the only module that builds windows.

Every window is partitioned by ``atm_id`` with the same order keys, so the whole
chain plans with a single hash exchange on ``atm_id`` and a single sort inside it.
Frames are ROWS frames: the reference counts rows, not calendar days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.calendar import compound_columns, flag
from tillcast.functions.numeric import exact_mean
from tillcast.operators.joins import checked_broadcast, hold

ENTITY = "atm_id"
# Order inside a machine: date with undated rows last, then a tie-break for duplicate
# (atm_id, date) rows, which have no defined order of their own.
TIE_BREAK = ("state", "holiday_name", "dispense")


def panel_order(df: DataFrame) -> list[Column]:
    """W0 as an order spec (not a global sort)."""
    keys = [F.col("date").asc_nulls_last()]
    keys += [F.col(c).asc_nulls_last() for c in TIE_BREAK if c in df.columns]
    return keys


def entity_window(df: DataFrame):
    return Window.partitionBy(ENTITY).orderBy(*panel_order(df))


def order_struct(df: DataFrame) -> Column:
    """The panel order as one comparable struct (NULLS LAST emulated with is-null flags)."""
    parts = [F.col("date").isNull(), F.col("date")]
    for c in TIE_BREAK:
        if c in df.columns:
            parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*parts)


def machine_stats(df: DataFrame) -> DataFrame:
    """One row per machine: rows and total dispense (missing skipped), from one partial
    aggregation over the input. Held: the skew check and A1 both read it."""
    return hold(df.where(F.col(ENTITY).isNotNull()).groupBy(ENTITY)
                .agg(F.count(F.lit(1)).alias("_n"), F.sum("dispense").alias("_total")))


def drop_inactive(df: DataFrame, broadcast_max_rows: int = 2_000_000, stats: DataFrame | None = None) -> DataFrame:
    """A1: keep machines whose total dispense (missing skipped) is > 0; drops NULL ids.

    Totals come from a partial aggregation (map-side combine, so a hot machine is no
    problem) and the surviving ids filter the panel through a semi join, broadcast
    behind a size check. The panel is not sorted or shuffled for this step.
    """
    stats = stats if stats is not None else machine_stats(df)
    active = stats.where(F.col("_total") > 0).select(F.col(ENTITY).alias("_a_atm"))
    active, _ = checked_broadcast(active, broadcast_max_rows)
    return df.join(active, df[ENTITY] == active["_a_atm"], "left_semi")


def removed_atm_count(df: DataFrame) -> DataFrame:
    """A2: distinct machines whose total is exactly 0 (all-missing counts as 0)."""
    per = (df.where(F.col(ENTITY).isNotNull())
           .groupBy(ENTITY).agg(F.coalesce(F.sum("dispense"), F.lit(0)).alias("total")))
    return per.where(F.col("total") == 0).agg(F.count(F.lit(1)).alias("removed_atms"))


def rolling_mean(value: str, w, size: int, min_periods: int) -> Column:
    """Mean of the ``size`` previous rows (current excluded), NULL unless at least
    ``min_periods`` of them are non-missing."""
    frame = w.rowsBetween(-size, -1)
    n = F.count(value).over(frame)
    return F.when(n >= min_periods, exact_mean(F.sum(value).over(frame), n))


def window_feature_columns(w, cfg: ForecastConfig) -> dict[str, Column]:
    """W1, W4-W7 and the W2 block-start flag over any per-machine row order ``w``.

    Needs ``_off`` (the off-day flag). Shared by the one-exchange plan and the chunked
    plan for hot machines (``tillcast.operators.skew``).
    """
    prev_off = F.lag("_off", 1).over(w)
    cols = {
        "is_pre_holiday": F.coalesce(F.lead("is_holiday", 1).over(w), F.lit(0)).cast("int"),
        "_start": F.when(prev_off.isNull() | (prev_off != F.col("_off")), 1).otherwise(0),
    }
    for k in cfg.lags:
        cols[f"dispense_lag_{k}"] = F.lag("dispense", k).over(w)
    cols[f"dispense_roll_mean_{cfg.roll_short}"] = rolling_mean("dispense", w, cfg.roll_short, cfg.roll_short)
    cols[f"dispense_roll_mean_{cfg.roll_long}"] = rolling_mean(
        "dispense", w, cfg.roll_long, cfg.roll_long_min_periods)
    return cols


def block_look_ahead(w) -> Column:
    """Dated rows among the next two rows that stay in the current off/on block."""
    same1 = F.coalesce(F.lead("_start", 1).over(w), F.lit(1)) == 0
    same2 = same1 & (F.coalesce(F.lead("_start", 2).over(w), F.lit(1)) == 0)
    return (F.when(same1, F.coalesce(F.lead("_dated", 1).over(w), F.lit(0))).otherwise(0)
            + F.when(same2, F.coalesce(F.lead("_dated", 2).over(w), F.lit(0))).otherwise(0))


def off_flag() -> Column:
    return flag((F.col("is_weekend") == 1) | (F.col("is_holiday") == 1))


def finish_blocks(df: DataFrame, blk_len: Column) -> DataFrame:
    """W3 + P8-P11 once the block length is known."""
    df = df.withColumn("is_long_weekend", flag((F.col("_off") == 1) & (blk_len >= 3)))
    return df.withColumns(compound_columns())


def add_row_features(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """W1-W7 and P8-P11 on the joined panel (before any row is dropped).

    Every window here uses the same partitioning and order, so the chain costs one
    sort. W3 only needs to know whether an off-day block holds at least 3 dated rows:
    dated rows of the block up to the current row come from running counts, and at
    most 2 more are needed from the rows that follow (bounded leads). Undated rows
    sort last, so no dated row of the block can hide behind them.
    """
    w = entity_window(df)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"_off": off_flag(), "_dated": F.col("date").isNotNull().cast("int")})
    df = df.withColumns({**window_feature_columns(w, cfg), "_cum": F.sum("_dated").over(run)})
    block_start = F.max(F.when(F.col("_start") == 1, F.col("_cum") - F.col("_dated"))).over(run)
    df = df.withColumn("_len", F.col("_cum") - block_start + block_look_ahead(w))
    df = finish_blocks(df, F.col("_len"))
    return df.drop("_off", "_dated", "_start", "_cum", "_len")


def hot_machines(stats: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """``_h_atm``: every machine with more than ``hot_key_min_rows`` rows."""
    return stats.where(F.col("_n") > cfg.hot_key_min_rows).select(F.col(ENTITY).alias("_h_atm"))


def off_day_blocks(df: DataFrame, cfg: ForecastConfig | None = None) -> DataFrame:  # noqa: ARG001 - same form as the chunked plan
    """W2/W3 exposed for inspection: off flag, block id and block length per row."""
    w = entity_window(df)
    off = flag((F.col("is_weekend") == 1) | (F.col("is_holiday") == 1))
    df = df.withColumn("is_off_day", off)
    prev_off = F.lag("is_off_day", 1).over(w)
    df = df.withColumn("_start", F.when(prev_off.isNull() | (prev_off != F.col("is_off_day")), 1).otherwise(0))
    df = df.withColumn("off_block_id", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("off_block_length", F.count("date").over(Window.partitionBy(ENTITY, "off_block_id")))
    return df.drop("_start")


def drop_invalid_rows(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Runs after the lags, so a dropped row still occupied its lag slot."""
    return df.na.drop(subset=list(cfg.required_columns))


def add_targets(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Dispense k rows ahead, on the already-filtered panel."""
    w = entity_window(df)
    return df.withColumns({t: F.lead("dispense", k).over(w) for _, t, k in cfg.horizons})


def eligible_rows(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Rows with lag 7 and the long rolling mean present."""
    return df.na.drop(subset=["dispense_lag_7", f"dispense_roll_mean_{cfg.roll_long}"])


def latest_per_atm(df: DataFrame) -> DataFrame:
    """The last row of every machine, as an aggregation (max_by on the order struct).

    On a panel already partitioned by atm_id this needs no exchange and no sort.
    """
    cols = df.columns
    best = F.max_by(F.struct(*cols), order_struct(df)).alias("_row")
    return df.groupBy(ENTITY).agg(best).select(*[F.col(f"_row.{c}").alias(c) for c in cols])
