"""Prediction post-processing (M8) and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def postprocess_prediction(p: Column, clip_lower: bool = True) -> Column:
    """Floor at 0 (v1 only), then round half-to-even to whole units; NULL stays NULL."""
    if clip_lower:
        p = F.when(p < 0, F.lit(0.0)).otherwise(p)
    return F.bround(p.cast("double"), 0)


def exact_mean(total: Column, n: Column) -> Column:
    """sum / count as DOUBLE: the same IEEE operations as any SQL engine."""
    return total.cast("double") / n
