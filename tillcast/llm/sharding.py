"""Sharding by proportional stratified interleaving, in DataFrame functions.

The rows of each source are shuffled by a seeded hash and ranked; a row's fractional rank is
(rank + phase) / rows of its source, the phase a fixed number of the source between 0 and 1 that
keeps sources of equal size out of step; all rows sorted by fractional rank mix the sources
evenly, and equal cuts of that order are the shards, so every shard has the sources in the
proportions of the whole (law ``rows``: shards differ by one row at most).

No source is ranked in one task: rows are numbered within (source, slice of the hash) and
the global order within slices of the fractional rank, and the numbers of the rows before
each slice are summed from small tables of counts.

Defined results: a null text has size 8 and checksum 0; null sources are one source; a null id
is an id. Repeated rows are interchangeable: each gets a place of its own. An empty table
gives an empty result, fewer rows than shards leave shards empty. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.llm.common import narrow, stored

SLICE_BITS = 12  # slices of the hash within a source, and of the fractional rank, as a power of 2


def interleave(docs: DataFrame, shards: int = 24, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", slice_bits: int = SLICE_BITS) -> DataFrame:
    """One row per row: the id, size, text_crc32, source, shard, slot (from 0 in each shard)."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = narrow(docs, row_id=id_col, text=text_col, source=source_col).select(
        "row_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("stratum", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("null")))
    rows = rows.withColumn("shuffle", F.xxhash64(F.lit(seed), "row_id", "text_crc32", "size"))
    rows = stored(rows.withColumn("slice", F.shiftrightunsigned("shuffle", 64 - slice_bits)), "rows")

    counts = rows.groupBy("stratum", "slice").agg(F.count("*").alias("n"))
    in_order = W.partitionBy("stratum").orderBy("slice")  # 2**slice_bits rows a source at most
    before = stored(counts.select("stratum", "slice", (F.sum("n").over(in_order) - F.col("n")).alias("before"),
                                  F.sum("n").over(W.partitionBy("stratum")).alias("in_stratum")), "strata")
    place = F.row_number().over(W.partitionBy("stratum", "slice").orderBy("shuffle", "row_id", "text_crc32", "size"))
    ranked = rows.withColumn("place", place).join(before, ["stratum", "slice"])
    phase = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "stratum"), 12) / F.lit(float(1 << 52))
    ranked = ranked.withColumn("fraction", (F.col("before") + F.col("place") - 1 + phase) / F.col("in_stratum"))
    ranked = stored(ranked.withColumn("cut", F.least(F.floor(F.col("fraction") * (1 << slice_bits)), F.lit((1 << slice_bits) - 1))).select(
        "row_id", "source", "stratum", "size", "text_crc32", "fraction", "cut"), "ranked")

    cuts = ranked.groupBy("cut").agg(F.count("*").alias("n"))  # 2**slice_bits rows at most, whatever the input
    total = cuts.agg(F.sum("n")).first()[0] or 0
    start = F.broadcast(cuts.select("cut", (F.sum("n").over(W.orderBy("cut")) - F.col("n")).alias("start")))
    place = F.row_number().over(W.partitionBy("cut").orderBy("fraction", "stratum"))
    placed = ranked.withColumn("place", place).join(start, "cut").withColumn("at", F.col("start") + F.col("place") - 1)
    shard = F.expr(f"(at * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("row_id").alias(id_col), "size", "text_crc32", F.col("source").alias(source_col), F.col("shard").cast("int").alias("shard"),
        (F.col("at") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 1, id_col: str = "doc_id", source_col: str = "source") -> None:
    """The documents (unique ids) as Parquet, a folder for each shard, rows in slot order within each file."""
    places = interleave(docs, shards, seed, id_col, source_col=source_col).select(F.col(id_col).alias("place_id"), "shard", "slot")
    rows = docs.join(places, F.col(id_col).eqNullSafe(F.col("place_id"))).drop("place_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
