"""Join helpers: size-checked broadcast and null-safe left joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bound of what one broadcast may ship to every executor.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_row_bytes(schema: T.StructType) -> int:
    """Conservative in-memory width of a row: fixed-width types at 8 bytes, strings
    and nested values at a generous average, plus the row header."""
    width = 16
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
            width += 8
        elif isinstance(dt, T.StringType):
            width += 48
        else:
            width += 128
    return width


_HELD: list[DataFrame] = []


def hold(df: DataFrame) -> DataFrame:
    """Cache a small table that one plan reads several times, until ``release``."""
    df = df.persist()
    _HELD.append(df)
    return df


def release() -> None:
    """Drop every held table; a plan that still needs one computes it again."""
    while _HELD:
        _HELD.pop().unpersist()


def checked_broadcast(dim: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``dim`` only when its counted size is proven small: at most ``max_rows``
    rows and at most ``max_bytes`` by a conservative per-row width.

    The dimension is held first so the count and the join read it once; a cached
    block lost with an executor is recomputed from lineage. Above the caps nothing stays
    cached: the caller gets the plain DataFrame back and Spark shuffles both sides.
    """
    held = hold(dim)
    n = held.count()
    if n <= max_rows and n * estimated_row_bytes(dim.schema) <= max_bytes:
        return F.broadcast(held), True
    held.unpersist()
    _HELD.remove(held)
    return dim, False


def bounded_broadcast(df: DataFrame, bound_rows: int, max_rows: int,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast on a row bound proven by construction (no counting job)."""
    if bound_rows <= max_rows and bound_rows * estimated_row_bytes(df.schema) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "_r_") -> DataFrame:
    """LEFT JOIN on ``keys`` where NULL matches NULL (as the reference's frame merge does).

    Right-side key columns are dropped; its other columns keep their names.
    """
    renamed = right.select(*[F.col(k).alias(prefix + k) for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])
    return left.join(renamed, cond, "left").drop(*[prefix + k for k in keys])
