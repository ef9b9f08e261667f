"""Row numbers inside a group without sending a whole group to one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts every row of a group into one
task. When a group can be very large (one horizon of a million-machine report, the
distinct values of a categorical column, one hot machine), range-partition on the
composite key instead: a large group is then spread over several partitions in key
order. Each partition numbers its rows locally; a tiny table of per-(partition, group)
counts gives the offset of every partition inside its group.

The partition/group table has at most ``partitions + groups - 1`` rows, because a range
boundary cuts at most one group. It is broadcast only when its counted size is under the
caps of ``checked_broadcast``; otherwise it is shuffled like any other join side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.joins import checked_broadcast
from tillcast.session import cut_lineage

def with_ordinal(df: DataFrame, group_cols: list[str], order: list[Column], name: str = "ordinal",
                 num_partitions: int | None = None, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Add ``name`` = 1-based row number of each row inside its group, by ``order``.

    ``order`` must be a total order inside a group for a deterministic result (rows
    equal in every order key are interchangeable, so any numbering of them is valid).
    """
    keys = [F.col(g).asc_nulls_last() for g in group_cols] + list(order)
    # Without an explicit count the range shuffle uses the session's partition setting and
    # AQE may coalesce it for small inputs; a caller-given count is kept as is.
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys))
    ranged = (ranged
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Ids depend on the physical layout: materialise once so both uses below agree.
    ranged = cut_lineage(ranged)

    blocks = ranged.groupBy("_pid", *group_cols).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    blocks = blocks.select(F.col("_pid").alias("_b_pid"), *[F.col(g).alias(f"_b_{g}") for g in group_cols],
                           "_first", "_offset", "_n")
    blocks, _ = checked_broadcast(blocks, broadcast_max_rows)
    cond = ranged["_pid"] == blocks["_b_pid"]
    for g in group_cols:
        cond = cond & ranged[g].eqNullSafe(blocks[f"_b_{g}"])
    out = ranged.join(blocks, cond, "inner")
    out = out.withColumn(name, F.col("_offset") + F.col("_mid") - F.col("_first") + F.lit(1))
    return out.drop("_pid", "_mid", "_b_pid", "_first", "_offset", "_n", *[f"_b_{g}" for g in group_cols])


def with_group_size(df: DataFrame, group_cols: list[str], name: str = "group_rows",
                    broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Add the row count of each group via a partial aggregation and a join (no window)."""
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(name))
    sizes = sizes.select(*[F.col(g).alias(f"_s_{g}") for g in group_cols], name)
    sizes, _ = checked_broadcast(sizes, broadcast_max_rows)
    cond = reduce(lambda a, b: a & b, [df[g].eqNullSafe(sizes[f"_s_{g}"]) for g in group_cols])
    return df.join(sizes, cond, "inner").drop(*[f"_s_{g}" for g in group_cols])
