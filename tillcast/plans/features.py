"""Feature plan: transactions (+ holidays / calendar / metadata) -> feature panel -> dataset.

The whole chain is one lazy DataFrame. Planned shape: the scans, one hash exchange on
atm_id (created by the first window), broadcast holiday/metadata dimensions behind
row-count checks, then sorts and windows inside the same partitions.

Skew guard: machines with more than ``hot_key_min_rows`` rows (found with one
aggregation, any number of them, kept as a table) take the chunked plan of ``tillcast.operators.skew`` instead,
so no task ever holds one whole hot machine. Both branches give identical rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig, V1
from tillcast.functions.calendar import calendar_columns
from tillcast.functions.coerce import normalize_key, to_date_lenient, to_number
from tillcast.operators import holidays as hol
from tillcast.operators import metadata as meta
from tillcast.operators import panel, skew
from tillcast.operators.joins import checked_broadcast
from tillcast.operators.tasks import dealt
from tillcast.sources.readers import TRANSACTION_COLUMNS, require_columns


def prepare_transactions(tx: DataFrame, cfg: ForecastConfig = V1, metadata: DataFrame | None = None) -> DataFrame:
    """Schema check, optional metadata join (J3), coercion (C1, C3) and key normalisation."""
    required = list(TRANSACTION_COLUMNS)
    if "state" in cfg.holiday_join_keys and cfg.holiday_source == "table":
        required.append("state")
    require_columns(tx, required, "transactions")
    if cfg.use_metadata:
        if metadata is None:
            raise ValueError(f"preset {cfg.name} needs the atm_metadata table")
        tx = meta.join_metadata(tx, metadata, cfg.broadcast_max_rows)
    cols = {"dispense": to_number(tx, "dispense"), "date": to_date_lenient(tx, "date", cfg.date_formats)}
    if cfg.normalize_state and "state" in tx.columns:
        cols["state"] = normalize_key(F.col("state"))
    return tx.withColumns(cols)


def _holiday_joiner(cfg: ForecastConfig, holidays: DataFrame | None,
                    calendar: DataFrame | None) -> Callable[[DataFrame], DataFrame]:
    """Build (and size-check) the holiday dimension once; return the join step."""
    if cfg.holiday_source == "table":
        if holidays is None:
            raise ValueError(f"preset {cfg.name} needs the holiday_master table")
        dim, _ = checked_broadcast(hol.holiday_dimension(holidays, cfg), cfg.broadcast_max_rows)
        return lambda df: hol.join_holidays(df, dim, cfg, checked=True)
    if calendar is None:
        raise ValueError(f"preset {cfg.name} needs a country calendar (date, holiday_name)")
    dim, _ = checked_broadcast(hol.calendar_dimension(calendar, cfg), cfg.broadcast_max_rows)
    return lambda df: hol.join_country_calendar(df, calendar, cfg, dim=dim)


def _chain(df: DataFrame, cfg: ForecastConfig, join: Callable[[DataFrame], DataFrame],
           chunked: bool, targets: bool, stats: DataFrame | None, rows: int | None) -> DataFrame:
    if cfg.drop_inactive:
        df = panel.drop_inactive(df, cfg.broadcast_max_rows, stats)
    df = join(df.withColumns(calendar_columns("date")))
    df = skew.chunked_row_features(df, cfg) if chunked else panel.add_row_features(dealt(df, rows, panel.ENTITY), cfg)
    if cfg.use_metadata:
        df = meta.fill_unknown(df)
    df = panel.drop_invalid_rows(df, cfg)
    if targets:
        df = skew.chunked_targets(df, cfg, rows) if chunked else panel.add_targets(df, cfg)
        df = panel.eligible_rows(df, cfg)
    return df.drop("_vord")


def _run(tx, holidays, cfg, calendar, metadata, targets: bool) -> DataFrame:
    # Rows without a machine id are dropped by C8 in every preset and never reach another
    # machine's window: remove them first so they cannot form one giant window group.
    df = prepare_transactions(tx, cfg, metadata).where(F.col(panel.ENTITY).isNotNull())
    join = _holiday_joiner(cfg, holidays, calendar)
    # one pass over the input serves both the skew check and A1
    stats = panel.machine_stats(df) if (cfg.skew_guard or cfg.drop_inactive) else None
    if stats is None:
        return _chain(df, cfg, join, False, targets, stats, None)
    over = F.col("_n") > (cfg.hot_key_min_rows if cfg.skew_guard else F.lit(None))
    rows, hot_rows, machines, n_hot = stats.agg(F.sum("_n"), F.sum(F.when(over, F.col("_n"))), F.count(F.lit(1)), F.count_if(over)).first()
    if not n_hot or n_hot == machines:  # one branch: the other would read the whole panel for nothing
        return _chain(df, cfg, join, bool(n_hot), targets, stats, rows)
    hot, _ = checked_broadcast(panel.hot_machines(stats, cfg), cfg.broadcast_max_rows)
    is_hot = df[panel.ENTITY] == hot["_h_atm"]
    cold = _chain(df.join(hot, is_hot, "left_anti"), cfg, join, False, targets, stats, rows - hot_rows)
    return cold.unionByName(_chain(df.join(hot, is_hot, "left_semi"), cfg, join, True, targets, stats, hot_rows))


def engineer_features(tx: DataFrame, holidays: DataFrame | None = None, cfg: ForecastConfig = V1,
                      calendar: DataFrame | None = None, metadata: DataFrame | None = None) -> DataFrame:
    """Feature panel (the reference's load-and-engineer step), rows with missing
    critical values already dropped (C8)."""
    return _run(tx, holidays, cfg, calendar, metadata, targets=False)


def feature_dataset(tx: DataFrame, holidays: DataFrame | None = None, cfg: ForecastConfig = V1,
                    calendar: DataFrame | None = None, metadata: DataFrame | None = None) -> DataFrame:
    """Feature panel + horizon targets (W8) + eligibility (D1): the training/scoring set."""
    return _run(tx, holidays, cfg, calendar, metadata, targets=True)


def build_dataset(features: DataFrame, cfg: ForecastConfig = V1) -> DataFrame:
    """W8 + D1 on a feature panel from ``engineer_features``, with the same skew guard."""
    return panel.eligible_rows(guarded(features, cfg, panel.add_targets, skew.chunked_targets), cfg)


def guarded(df: DataFrame, cfg: ForecastConfig, whole: Callable, chunked: Callable) -> DataFrame:
    """One windowed step: ``whole`` for ordinary machines, ``chunked`` for hot ones."""
    stats = panel.machine_stats(df) if cfg.skew_guard else None
    hot = panel.hot_machines(stats, cfg) if cfg.skew_guard else None
    if hot is None or hot.isEmpty():
        return whole(df, cfg)
    hot, _ = checked_broadcast(hot, cfg.broadcast_max_rows)
    is_hot = df[panel.ENTITY].eqNullSafe(hot["_h_atm"])
    return whole(df.join(hot, is_hot, "left_anti"), cfg).unionByName(chunked(df.join(hot, is_hot, "left_semi"), cfg))
