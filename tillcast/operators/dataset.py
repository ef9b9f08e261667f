"""Dataset building (D2-D6): time split, diagnostics, per-horizon training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.session import cut_lineage


def ensure_not_empty(df: DataFrame, message: str = "No data available after feature engineering.") -> DataFrame:
    """Fail early when nothing is left. For a materialised panel: on a plan with windows
    even one row costs the whole chain."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def last_date(cleaned: DataFrame):
    """Global max date of a materialised panel: one value."""
    return cleaned.agg(F.max("date")).first()[0]


def time_split(cleaned: DataFrame, cfg: ForecastConfig, max_date=None) -> DataFrame:
    """D3: ``split_date`` = max date minus N days, ``is_val`` = date after it.

    Without a known max date the panel is materialised first, so that the date and the
    split read one result instead of running the feature chain twice.
    """
    if max_date is None:
        cleaned = cut_lineage(cleaned)
        max_date = last_date(cleaned)
    cut = F.date_sub(F.lit(max_date).cast("date"), cfg.val_days)
    return cleaned.withColumns({"split_date": cut, "is_val": (F.col("date") > cut)})


def split_diagnostics(split: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Rows and non-null targets for cleaned / train / validation in one pass (ROLLUP)."""
    side = F.when(F.col("is_val"), F.lit("validation")).otherwise(F.lit("train")).alias("side")
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count(t).alias(f"n_{t}") for _, t, _ in cfg.horizons]
    out = split.select(side, *[t for _, t, _ in cfg.horizons]).rollup("side").agg(*aggs)
    return out.withColumn("split", F.coalesce(F.col("side"), F.lit("cleaned"))).drop("side")


def horizon_training_sets(split: DataFrame, cfg: ForecastConfig, columns: list[str] | None = None) -> DataFrame:
    """D5 for all horizons as one long DataFrame, in one pass: (horizon, is_val, columns..., target)."""
    cols = columns or ["atm_id", "date"]
    sets = F.array(*[F.struct(F.lit(label).alias("horizon"), F.col(t).alias("target")) for label, t, _ in cfg.horizons])
    long = split.select("is_val", *cols, F.inline(sets)).where(F.col("target").isNotNull())
    return long.select("horizon", "is_val", *cols, "target")


def feature_projection(df: DataFrame, cfg: ForecastConfig, with_targets: bool = True) -> DataFrame:
    """The fixed, ordered feature list (plus date and targets for the training step)."""
    targets = [t for _, t, _ in cfg.horizons] if with_targets else []
    keep = list(dict.fromkeys(["date", *cfg.features, *targets]))
    return df.select(*keep)
