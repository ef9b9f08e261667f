"""Sinks (S5, S8): Snappy Parquet and the partitioned forecast report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Snappy Parquet, overwrite by default."""
    w = df.write.mode(mode).option("compression", "snappy")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report(report: DataFrame, path: str, fmt: str = "parquet", max_rows_per_file: int = 1_000_000) -> None:
    """One directory per horizon and forecast date, a sheet's rows in one file, files capped at
    the sheet row limit. Parquet by default; CSV with a header on request.

    A write replaces the directories of its own horizons and dates and leaves those of other dates,
    so the folder keeps every run and a repeated run leaves nothing of the one before. Rows are
    placed by sheet before the write: a sheet has at most the sheet limit, which bounds a task,
    and as many files come out as there are sheets at most.
    """
    sheet = ["horizon", "forecast_date", "sheet"]
    placed = report.repartition(*sheet).sortWithinPartitions(*sheet)
    w = (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("horizon", "forecast_date")
         .option("maxRecordsPerFile", int(max_rows_per_file)))
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.option("compression", "snappy").parquet(path)
