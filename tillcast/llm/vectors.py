"""Vector columns as exact integers: what the operators on embeddings share.

Every component c becomes floor(factor * c), c as double. A row whose vector is null or empty or
holds a null, a NaN, an infinity or a component beyond ``MOST`` after scaling takes no part, nor
does one whose length is not the most frequent length of the table (the longer of equals).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import map_arrow, stored

#: Largest scaled component by magnitude: products of two, summed over 2^11 components, fit into 64 bits.
MOST = 1 << 26


def exact(vectors: pa.Array, factor: int, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, their lengths, their scaled components end to end)."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(vectors.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(flat * factor)
        wrong = ~(np.abs(scaled) <= most)
    ends = np.cumsum(lengths)
    n_wrong = np.r_[0, np.cumsum(wrong)]
    fits = (lengths > 0) & (n_wrong[ends] == n_wrong[ends - lengths])
    return np.flatnonzero(fits), lengths[fits], scaled[np.repeat(fits, lengths)].astype(np.int64)


def binary_rows(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary value of each row's own components; ``data`` holds them end to end."""
    offsets = np.r_[0, np.cumsum(lengths * data.itemsize)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """The rows of a binary column without nulls, as a matrix."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]].view(dtype).reshape(len(column), width)


def coded(df: DataFrame, keep: list[str], vec_col: str, factor: int, more: Callable[[np.ndarray, np.ndarray], dict] | None = None,
          fields: list[T.StructField] | None = None, name: str = "vectors") -> tuple[DataFrame, int]:
    """(stored table of the ``keep`` columns, ``x`` as little-endian int32 and what ``more`` adds, dimension).

    ``more(components end to end, lengths)`` gives further columns by name, declared in ``fields``.
    """
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("dims", T.IntegerType()), T.StructField("x", T.BinaryType())] + (fields or []))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        rows, lengths, flat = exact(batch.column(vec_col), factor)
        yield {c: batch.column(c).take(pa.array(rows)) for c in keep} | {
            "dims": lengths.astype(np.int32), "x": binary_rows(flat.astype("<i4"), lengths)} | (more(flat, lengths) if more else {})

    table = stored(map_arrow(df.select(*keep, vec_col), work, schema), name)
    counts = {r.dims: r.n for r in table.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()}
    dims = next(iter(counts), 0)
    return table.where(F.col("dims") == dims).drop("dims"), dims
