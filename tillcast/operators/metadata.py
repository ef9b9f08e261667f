"""Machine metadata join (J3) with percent cleanup (C2) and category fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.coerce import to_percent_number
from tillcast.operators.joins import checked_broadcast
from tillcast.sources.readers import require_columns

METADATA_COLUMNS = ("atm_id", "location_type", "city_tier", "uptime_pct", "downtime_pct")
UNKNOWN = "Unknown"


def clean_metadata(meta: DataFrame) -> DataFrame:
    """C2 on the percent columns; the table keeps one row per input row."""
    require_columns(meta, METADATA_COLUMNS, "atm_metadata")
    return meta.withColumns({
        "uptime_pct": to_percent_number(meta, "uptime_pct"),
        "downtime_pct": to_percent_number(meta, "downtime_pct"),
    })


def join_metadata(tx: DataFrame, meta: DataFrame, broadcast_max_rows: int) -> DataFrame:
    """LEFT JOIN on atm_id. One row per machine, so the side is broadcast only when
    its counted size allows; otherwise the shuffle on atm_id is the same exchange the
    panel windows need, and Spark reuses it."""
    meta = clean_metadata(meta)
    meta, _ = checked_broadcast(meta, broadcast_max_rows)
    return tx.join(meta, on="atm_id", how="left")


def fill_unknown(df: DataFrame, cols=("location_type", "city_tier")) -> DataFrame:
    """Missing categorical metadata -> 'Unknown'."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in present})
