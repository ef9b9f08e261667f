"""Sizes of tasks that sort a panel: by counted rows, so that a task's memory does not grow with the table."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a panel that one task sorts and holds, about.
TASK_ROWS = 250_000


def tasks_for(df: DataFrame, rows: int | None) -> int | None:
    """Number of tasks for so many rows; None where that is no more than the cluster runs at once: Spark then merges small
    partitions itself, but otherwise it would merge them up to a size that the rows, once decoded, exceed many times."""
    n = -(-(rows or 0) // TASK_ROWS)
    return n if n > df.sparkSession.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` into tasks of about ``TASK_ROWS`` rows: the one shuffle of the windows and joins that follow."""
    n = tasks_for(df, rows)
    return df.repartition(n, *keys) if n else df
