"""Category codes (C9): the rank of a value among the sorted distinct values of its column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.ordinal import with_ordinal


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, code) for every distinct value; a missing value has no code.

    Each column is made distinct on its own (partial aggregation before the shuffle) and
    numbered without a one-task window.
    """
    values = reduce(DataFrame.unionByName, [
        df.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")).where(F.col(c).isNotNull()).distinct() for c in columns])
    coded = with_ordinal(values, ["column_name"], [F.col("value").asc_nulls_last()], "code")
    return coded.withColumn("code", (F.col("code") - 1).cast("int"))
