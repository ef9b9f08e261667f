"""Small helpers shared by the operators: Arrow mapping, scratch tables, size-checked joins."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.joins import BROADCAST_MAX_BYTES, estimated_row_bytes
from tillcast.session import scratch_path, shared_dir, stored

__all__ = ["BROADCAST_MAX_BYTES", "content_key", "stored", "small_enough", "map_arrow", "narrow", "read_table", "small_batches", "scratch_path", "shared_dir"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **cols: str | T.DataType) -> DataFrame:
    """Only the named columns, as name=source column; further columns, whatever their names, end here."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in cols.items()])


def content_key(*cols: str) -> F.Column:
    """128-bit key of the values of some columns, nulls told apart from all values: what a verdict that depends on
    nothing else is joined back on, so that rows with one id, or none, get each their own."""
    parts = [x for c in cols for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.concat_ws(":", F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts, F.lit(3)))


def small_enough(df: DataFrame, rows: int | None = None, most: int = BROADCAST_MAX_BYTES) -> bool:
    """True when the counted rows at a conservative width fit into one broadcast."""
    rows = df.count() if rows is None else rows
    return rows * estimated_row_bytes(df.schema) <= most


#: Rows of one Arrow batch between Spark and a Python worker: texts of a few KB make batches of a few MB.
BATCH_ROWS = 2000
#: Bytes of one, for tables of long texts.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keeps a worker's memory to a few batches of texts; a smaller setting of the session stands."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(limit).rstrip("b")) > BATCH_BYTES:  # read back as a number of bytes
        spark.conf.set(limit, str(BATCH_BYTES))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Large tables that operators hold in a worker process between tasks, by name.
_WORKER_TABLES: dict[str, dict] = {}


def worker_tables(name: str) -> dict:
    """A dictionary for them that is emptied when the worker goes on to an operator that does not use it."""
    return _WORKER_TABLES.setdefault(name, {})


def use_only(name: str | None) -> None:
    """At the start of a task: all worker tables but those of ``name`` are emptied, their memory goes back to the system."""
    held = [x for k, x in _WORKER_TABLES.items() if x and k != name]
    if held:
        for x in held:
            x.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # the C library of another system
            ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: T.StructType, tables: str | None = None) -> DataFrame:
    """``fn`` turns one Arrow batch into column dicts (name -> array or list); each becomes a batch.
    ``tables``: name of the worker tables that ``fn`` uses; others are given up."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    target = to_arrow_schema(schema)

    def run(batches):
        use_only(tables)
        for batch in batches:
            if batch.num_rows:
                for cols in fn(batch):
                    yield pa.RecordBatch.from_arrays(
                        [_array(cols[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.cast(kind) if values.type != kind else values
    return pa.array(values, type=kind)
