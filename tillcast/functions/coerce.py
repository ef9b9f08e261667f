"""Cleaning expressions: numeric, percent, date coercion and key normalisation.

All of them are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A number as a lenient text parser accepts it: sign, digits, decimal point, exponent,
# or inf/infinity, with surrounding whitespace. Spark's cast alone also accepts a
# trailing type suffix ("1d") and "NaN", which must come out missing.
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"

# Leading/trailing whitespace in the Unicode sense (a no-break space counts).
EDGE_SPACE = r"(?U)^\s+|\s+$"



def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def nan_to_null(c: Column) -> Column:
    """NaN is a value in Spark but missing in the reference: map it to NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(df: DataFrame, name: str) -> Column:
    """Coerce a column to DOUBLE; anything unparsable becomes NULL."""
    c = F.col(name)
    dt = _dtype(df, name)
    if isinstance(dt, T.NumericType):
        return nan_to_null(c.cast("double"))
    if isinstance(dt, T.BooleanType):
        return c.cast("double")
    s = c.cast("string")
    return nan_to_null(F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double")))


def to_percent_number(df: DataFrame, name: str) -> Column:
    """Drop a literal '%' and coerce as C1 ('98%' -> 98.0)."""
    c = F.col(name)
    if isinstance(_dtype(df, name), T.NumericType):
        return nan_to_null(c.cast("double"))
    s = F.replace(c.cast("string"), F.lit("%"), F.lit(""))
    return nan_to_null(F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double")))


def to_date_lenient(df: DataFrame, name: str, formats: tuple[str, ...] = ("yyyy-MM-dd",)) -> Column:
    """Coerce to DATE trying each format in order; bad values become NULL.

    Timestamps are truncated to their date (the panel grain is one day).
    """
    c = F.col(name)
    dt = _dtype(df, name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    s = c.cast("string")
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def to_date_strict(df: DataFrame, name: str, fmt: str = "yyyy-MM-dd") -> Column:
    """C4: convert to DATE and fail the job on any value that does not parse."""
    c = F.col(name)
    dt = _dtype(df, name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    parsed = F.try_to_date(c.cast("string"), fmt)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"unparsable date in column {name}: "), c.cast("string")))
                  .cast("date")).otherwise(parsed)


def normalize_key(c: Column) -> Column:
    """To string, strip Unicode whitespace at both ends, upper-case. NULL stays NULL."""
    return F.upper(F.regexp_replace(c.cast("string"), EDGE_SPACE, ""))
