"""The panel stored by machine (S5, S6): a bucketed table that the windows read without a shuffle.

Every job on the panel (features, retraining, scoring) groups it by machine. Stored once in buckets
of the machine id, rows sorted by date, each bucket one file, a read has the partitioning that the
windows of W0-W9 and the aggregations by machine ask for: no exchange on ``atm_id``, however often
it is read. The table lives in the session's catalog; ``path`` names a folder that the cluster shares.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_ROWS = 4_000_000  # about 100 MB of a panel of five columns


def panel_buckets(rows: int, bucket_rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """Number of buckets for a panel of so many rows."""
    return max(least, math.ceil(rows / bucket_rows))


def write_panel(df: DataFrame, table: str, path: str | None = None, buckets: int = 8, key: str = "atm_id", sort: str = "date", mode: str = "overwrite") -> None:
    """Store ``df`` as ``table``; one shuffle by machine, one file for each bucket.

    Rows without a machine id share a bucket; a hot machine's rows lie in one bucket too, so
    reads that split it (the skew guard) go through its own plan.
    """
    w = df.repartition(buckets, F.col(key)).sortWithinPartitions(key, sort).write.mode(mode).format("parquet")
    w = w.bucketBy(buckets, key).sortBy(sort).option("compression", "snappy")
    (w.option("path", path) if path else w).saveAsTable(table)


def read_panel(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
