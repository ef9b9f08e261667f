"""Per-machine windows for hot machines, split into row chunks.

A window partitioned by ``atm_id`` sends every row of a machine to one task. For a
machine holding a large share of all rows that task would hold that share of the
data. Row-based frames are bounded (14 rows back, at most 7 ahead), so a machine can
be cut into fixed-size chunks of its own row sequence, each chunk carrying copies of
the few neighbouring rows its frames reach (a halo). Windows then partition by
``(atm_id, chunk)`` and give exactly the values of the unsplit window on the chunk's
own rows. The running (unbounded) values are rebuilt without one-task groups: each
chunk computes them locally and adds what all earlier chunks of the machine contribute,
read from a small per-chunk table (dated rows, last block start, rows kept by C8).

Where a chunk ends is read from a small table of rows by machine and day: a day is not divided, so
its rows' chunk and the chunks whose frames may reach it follow from the running count of the days,
and the rows are placed by one join and one shuffle, without sorting or storing them first. Only
where some day of a machine holds more than ``chunk_rows`` rows (a placeholder date, missing dates) do row
positions come from ``with_ordinal`` (range partitioning; no group in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.operators import panel
from tillcast.operators.joins import bounded_broadcast, checked_broadcast
from tillcast.operators.ordinal import with_ordinal
from tillcast.operators.tasks import dealt, tasks_for
from tillcast.session import cut_lineage

ENTITY = panel.ENTITY


def with_halo(df: DataFrame, ord_col: str, chunk_rows: int, back: int, fwd: int) -> DataFrame:
    """Assign each row to its home chunk and copy it into the neighbouring chunk whose
    frames reach it: the next chunk needs the last ``back`` rows, the previous chunk
    the first ``fwd`` rows. ``_home`` marks the original."""
    if back > chunk_rows or fwd > chunk_rows:
        raise ValueError("chunk_rows must exceed the window reach")
    pos = (F.col(ord_col) - 1) % chunk_rows
    home = F.floor((F.col(ord_col) - 1) / chunk_rows).cast("long")
    targets = F.array(
        F.struct(home.alias("c"), F.lit(True).alias("h")),
        F.when(pos >= chunk_rows - back, F.struct((home + 1).alias("c"), F.lit(False).alias("h"))),
        F.when((pos < fwd) & (home > 0), F.struct((home - 1).alias("c"), F.lit(False).alias("h"))),
    )
    out = df.withColumn("_t", F.explode(F.filter(targets, lambda x: x.isNotNull())))
    return out.withColumns({"_chunk": F.col("_t.c"), "_home": F.col("_t.h")}).drop("_t")


def _chunk_window(*order):
    return Window.partitionBy(ENTITY, "_chunk").orderBy(*order)


def day_chunks(df: DataFrame, chunk_rows: int, back: int, fwd: int) -> DataFrame:
    """(machine, date, rows of the day, home chunk, further chunks whose frames may reach the day).

    Days lie in date order, missing dates last. A chunk is the days that begin within the same ``chunk_rows`` rows of their
    machine. A day goes to a later chunk if it ends within ``back`` rows before that chunk, to an earlier one if it
    begins within ``fwd`` rows behind it; chunks between may be as short as one day, so several can be reached. A day has a row
    at least, so the first days of the later chunks are among the next ``back`` days and the last ones of the earlier among the
    ``fwd`` days before: one window over the days finds both.
    """
    days = df.groupBy(F.col(ENTITY).alias("_d_atm"), F.col("date").alias("_d_date")).agg(F.count(F.lit(1)).alias("_d_rows"))
    in_order = Window.partitionBy("_d_atm").orderBy(F.col("_d_date").asc_nulls_last())  # a row for each day
    first, chunk, end = F.col("_d_first"), F.col("_d_chunk"), F.col("_d_first") + F.col("_d_rows")
    days = days.withColumn("_d_first", F.sum("_d_rows").over(in_order) - F.col("_d_rows"))
    days = days.withColumn("_d_chunk", F.floor(first / chunk_rows).cast("long"))
    ahead = {i: (F.lead(first, i).over(in_order), F.lead(chunk, i).over(in_order)) for i in range(1, back + 1)}
    behind = {i: (F.lag(end, i).over(in_order), F.lag(chunk, i).over(in_order)) for i in range(1, fwd + 1)}
    days = days.withColumns({f"_a{i}": F.when((f < end + back) & (c > chunk), c) for i, (f, c) in ahead.items()}
                            | {f"_b{i}": F.when((e > first - fwd) & (c < chunk), c) for i, (e, c) in behind.items()})
    near = [*[f"_a{i}" for i in ahead], *[f"_b{i}" for i in behind]]
    more = F.array_distinct(F.array_compact(F.array(*near))) if near else F.array().cast("array<bigint>")
    return days.select("_d_atm", "_d_date", "_d_rows", "_d_chunk", more.alias("_d_more"))


def in_chunks(df: DataFrame, cfg: ForecastConfig, back: int, fwd: int) -> tuple[DataFrame, list]:
    """(the rows with ``_chunk`` and ``_home``, copied to the chunks that reach them; their order within a chunk).
    Every row has a machine."""
    days = cut_lineage(day_chunks(df, cfg.chunk_rows, back, fwd))
    largest, n_days, rows, copies = days.agg(F.max("_d_rows"), F.count(F.lit(1)), F.sum("_d_rows"), F.sum(F.col("_d_rows") * (F.size("_d_more") + 1))).first()
    if largest is not None and largest > cfg.chunk_rows:
        d = with_ordinal(df, [ENTITY], panel.panel_order(df), "_ord", tasks_for(df, rows), cfg.broadcast_max_rows)
        return dealt(with_halo(d, "_ord", cfg.chunk_rows, back, fwd), rows + rows * (back + fwd) // cfg.chunk_rows, ENTITY, "_chunk"), ["_ord"]
    days = days.withColumn("_d_day", _day("_d_date")).drop("_d_date")
    days, small = bounded_broadcast(days, n_days, cfg.broadcast_max_rows)
    left = df.withColumn("_day", _day("date"))
    if not small:  # both sides of the join in tasks of the same rows
        left, days = dealt(left, rows, ENTITY, "_day"), dealt(days, rows, "_d_atm", "_d_day")
    placed = left.join(days, (left[ENTITY] == days["_d_atm"]) & (left["_day"] == days["_d_day"]))
    targets = F.concat(F.array(F.struct(F.col("_d_chunk").alias("c"), F.lit(True).alias("h"))),
                       F.transform("_d_more", lambda c: F.struct(c.alias("c"), F.lit(False).alias("h"))))
    out = placed.withColumn("_t", F.explode(targets)).withColumns({"_chunk": F.col("_t.c"), "_home": F.col("_t.h")})
    out = out.drop("_t", "_day", "_d_atm", "_d_day", "_d_rows", "_d_chunk", "_d_more")
    return dealt(out, copies, ENTITY, "_chunk"), panel.panel_order(df)


def _day(date: str):
    """A date as a number that missing dates have too, for joins by plain equality."""
    return F.coalesce(F.unix_date(date), F.lit(-(1 << 31)).cast("int"))


def chunked_row_features(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Same output as ``panel.add_row_features`` for the machines in ``df``, plus ``_vord``: the row number among the rows that survive C8, used by
    ``chunked_targets``."""
    back = max([*cfg.lags, cfg.roll_short, cfg.roll_long, 1])
    d = df.withColumns({"_off": panel.off_flag(), "_dated": F.col("date").isNotNull().cast("int")})
    d, order = in_chunks(d, cfg, back, 2)
    w = _chunk_window(*order)
    d = d.withColumns(panel.window_feature_columns(w, cfg))
    d = d.withColumn("_ahead", panel.block_look_ahead(w)).where(F.col("_home"))
    # Running values inside the chunk. The machine-wide values add what earlier chunks
    # contribute, read from one small per-chunk table: dated rows (for the block length,
    # W3), the last block start (W2) and the rows C8 keeps (row numbers for W8).
    valid = F.lit(True)
    for c in cfg.required_columns:
        valid = valid & F.col(c).isNotNull()
    run = w.rowsBetween(Window.unboundedPreceding, 0)  # of home rows: copies are gone by now
    start_base = F.when(F.col("_start") == 1, F.col("_lcum") - F.col("_dated"))
    d = d.withColumns({"_valid": valid.cast("int"), "_lcum": F.sum("_dated").over(run)})
    d = d.withColumns({"_lbase": F.max(start_base).over(run), "_vlocal": F.sum("_valid").over(run)})
    per_chunk = d.groupBy(ENTITY, "_chunk").agg(
        F.sum("_dated").alias("_cd"), F.max(start_base).alias("_cb"), F.sum("_valid").alias("_cv"))
    earlier = Window.partitionBy(ENTITY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.withColumns({"_o_doff": F.coalesce(F.sum("_cd").over(earlier), F.lit(0)),
                                       "_o_voff": F.coalesce(F.sum("_cv").over(earlier), F.lit(0))})
    offsets = per_chunk.select(
        F.col(ENTITY).alias("_o_atm"), F.col("_chunk").alias("_o_chunk"), "_o_doff", "_o_voff",
        F.max(F.col("_cb") + F.col("_o_doff")).over(earlier).alias("_o_base"))
    # one row per (machine, chunk): read twice (size check and join), so written once
    offsets, _ = checked_broadcast(cut_lineage(offsets), cfg.broadcast_max_rows)
    d = d.join(offsets, (d[ENTITY] == offsets["_o_atm"]) & (d["_chunk"] == offsets["_o_chunk"]), "inner")
    base = F.coalesce(F.col("_o_doff") + F.col("_lbase"), F.col("_o_base"))
    d = d.withColumns({"_len": F.col("_o_doff") + F.col("_lcum") - base + F.col("_ahead"),
                       "_vord": F.col("_o_voff") + F.col("_vlocal")})
    d = panel.finish_blocks(d, F.col("_len"))
    return d.drop("_off", "_dated", "_start", "_ahead", "_valid", "_lcum", "_lbase", "_vlocal", "_len",
                  "_o_atm", "_o_chunk", "_o_doff", "_o_voff", "_o_base", "_ord", "_chunk", "_home")


def chunked_targets(df: DataFrame, cfg: ForecastConfig, rows: int | None = None) -> DataFrame:
    """Same output as ``panel.add_targets`` (leads on the filtered panel). Uses the
    ``_vord`` row numbers of ``chunked_row_features`` when present. ``rows``: about how many there are, if known."""
    fwd = max(k for _, _, k in cfg.horizons)
    if "_vord" in df.columns:
        d = df.withColumnRenamed("_vord", "_ord")
    else:
        d = with_ordinal(df, [ENTITY], panel.panel_order(df), "_ord", tasks_for(df, rows), cfg.broadcast_max_rows)
    d = dealt(with_halo(d, "_ord", cfg.chunk_rows, 0, fwd), rows and rows + rows * fwd // cfg.chunk_rows, ENTITY, "_chunk")
    w = _chunk_window("_ord")
    d = d.withColumns({t: F.lead("dispense", k).over(w) for _, t, k in cfg.horizons}).where(F.col("_home"))
    return d.drop("_ord", "_chunk", "_home")


def chunked_off_day_blocks(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Same output as ``panel.off_day_blocks``: block starts are counted in chunks, block
    lengths by an aggregation, so neither a machine nor a long block is one task's group."""
    d, order = in_chunks(df.withColumn("is_off_day", panel.off_flag()), cfg, 1, 0)
    w = _chunk_window(*order)
    prev_off = F.lag("is_off_day", 1).over(w)
    d = d.withColumn("_start", F.when(prev_off.isNull() | (prev_off != F.col("is_off_day")), 1).otherwise(0)).where(F.col("_home"))
    d = d.withColumn("_local", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = Window.partitionBy(ENTITY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy(ENTITY, "_chunk").agg(F.sum("_start").alias("_n")).select(
        F.col(ENTITY).alias("_o_atm"), F.col("_chunk").alias("_o_chunk"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    starts, _ = checked_broadcast(cut_lineage(starts), cfg.broadcast_max_rows)
    d = d.join(starts, d[ENTITY].eqNullSafe(starts["_o_atm"]) & (d["_chunk"] == starts["_o_chunk"]))
    d = d.withColumn("off_block_id", F.col("_before") + F.col("_local"))
    d = d.drop("_ord", "_chunk", "_home", "_start", "_local", "_o_atm", "_o_chunk", "_before")
    lengths = d.groupBy(F.col(ENTITY).alias("_b_atm"), F.col("off_block_id").alias("_b_id")).agg(F.count("date").alias("off_block_length"))
    return d.join(lengths, d[ENTITY].eqNullSafe(lengths["_b_atm"]) & (d["off_block_id"] == lengths["_b_id"])).drop("_b_atm", "_b_id")
