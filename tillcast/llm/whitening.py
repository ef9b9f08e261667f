"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows become integers x = floor(64 * component) + 1000000 (the shift cancels in every result, so it
is not carried along); the fit list holds every distinct x once, in blocks of some thousand rows
stored in the shared folder. With A the centred fit
list (n rows, d columns, never built: a task centres its blocks by exact integers, (n * x - S) / n),
the bidiagonalisation alternates u = A v - beta u' and v = A'u - alpha v', each new vector
reorthogonalised against all before it. A u has a place for every row of the fit list, so it is
not kept: every u is A w for a vector w of d numbers, and a task rebuilds its part of all u from
its blocks. One pass over the blocks gives both products of a step and the inner products with all
earlier u; where those are not small the step is passed over once more. What reaches the driver
in a step are sums over all blocks, some d numbers, added up on the executors.

All d steps are taken (``steps`` may name fewer for a leading part of wide vectors), so the singular
value decomposition of the d x d bidiagonal matrix is that of A: its right vectors times V are the
eigenvectors of the covariance, its squared values over n the eigenvalues. If a product leaves
nothing new (constant or dependent dimensions), the next v is a fresh direction orthogonal to all.

Defined results: rows without an exact vector take no part (see ``vectors``); a null id is an id.
Repeated rows count once in the fit and each get their result. Components whose eigenvalue is zero
within rounding (below 1e-13 of the first) are left out, as they cannot be whitened: a table without
two different vectors, or an empty one, gives an empty result. Of equal eigenvalues any orthonormal
basis may come out. A component's largest entry (the first of equals) is positive. ``deviation`` is
null where it does not fit 64 bits. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import map_arrow, narrow, stored
from tillcast.llm.vectors import coded, matrix

FACTOR = 64
COMPONENTS = 16
BLOCK_ROWS = 4096
#: Inner products with earlier vectors above this share of the new vector's length ask for a second pass.
AGAIN = 1e-6
#: Singular values below this share of the first are rounding.
ZERO = 3e-7


@dataclass
class Whitening:
    """Eigenvectors (columns) and eigenvalues of the covariance of the fit list."""

    dims: int
    n: int
    sums: np.ndarray  # of floor(64 c) by dimension, exact (objects)
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0
    passes: int = 0


def _blocks(table: DataFrame, dims: int) -> DataFrame:
    """Every distinct vector once, in blocks of rows."""
    distinct = table.select("x").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(matrix(batch.column(0), "<i4", dims))
            rows += len(held[-1])
            if rows >= BLOCK_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["block"])
                held, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["block"])

    return stored(distinct.mapInArrow(run, "block binary"), "blocks")


def _totals(blocks: DataFrame, dims: int, width: int, fn) -> np.ndarray:
    """Sum over all blocks of the ``width`` numbers that ``fn`` makes of each, added up on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for block in batch.column(0):
                total += fn(np.frombuffer(block.as_buffer(), dtype="<i4").reshape(-1, dims))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(width)
    for r in blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # width rows
        out[r.i] = r.v
    return out


def _moments(blocks: DataFrame, dims: int) -> tuple[int, np.ndarray, int]:
    """(rows, sum by dimension, sum of squares), exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dims, dtype=object), 0
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer(), dtype="<i4").reshape(-1, dims).astype(np.int64)
                n, sums = n + len(x), sums + x.sum(axis=0)
                squares += sum(map(int, (x * x).sum(axis=1)))
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 2, dtype=np.int32)), pa.array([n, squares, *map(int, sums)]).cast(kind)
                                          if max(map(abs, [squares, *sums]), default=0) < 2**62 else pa.array([_decimal(v) for v in (n, squares, *sums)], kind)], ["i", "v"])

    out = [0] * (dims + 2)
    for r in blocks.mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect():  # dims + 2 rows
        out[r.i] = int(r.v)
    return out[0], np.array(out[2:], dtype=object), out[1]


def _decimal(v: int):
    from decimal import Decimal

    return Decimal(int(v))


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n of every row: the numerator exact, one rounding by the division."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if most < 2**62:
        return (n * x.astype(np.int64) - sums.astype(np.int64)) / n
    return ((n * x.astype(object) - sums) / n).astype(np.float64)


def bidiagonalise(blocks: DataFrame, dims: int, n: int, sums: np.ndarray, steps: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, int]:
    """(V, upper bidiagonal B with A V = U B, passes): ``steps`` Lanczos vectors with full reorthogonalisation."""
    rng = np.random.default_rng(seed)
    v_all, w_all, back = np.zeros((dims, steps)), np.zeros((dims, steps)), np.zeros((dims, steps))  # back: A'u of every u
    b = np.zeros((steps, steps))
    passes, scale, beta = 0, 0.0, 0.0

    def fresh(j: int) -> np.ndarray:
        """A unit vector orthogonal to the first j of V."""
        while True:
            x = rng.standard_normal(dims)
            for _ in range(3):
                x -= v_all[:, :j] @ (v_all[:, :j].T @ x)
            if (size := np.linalg.norm(x)) > 1e-8:
                return x / size

    v = fresh(0)
    for j in range(steps):
        v_all[:, j] = v
        w = v - beta * w_all[:, j - 1] if j else v.copy()  # A w = A v - beta u'

        def products(w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
            """(A'A w, |A w|^2, inner products of A w with the earlier u)."""
            earlier = w_all[:, :j].copy()

            def fn(x: np.ndarray) -> np.ndarray:
                a = _centred(x, n, sums)
                p = a @ w
                return np.concatenate([a.T @ p, [p @ p], (a @ earlier).T @ p])

            got = _totals(blocks, dims, dims + 1 + j, fn)
            return got[:dims], got[dims], got[dims + 1:]

        for again in range(3):
            ata, square, h = products(w)
            passes += 1
            # taking out what earlier u have in common with the new one; h is small, so nothing cancels
            w = w - w_all[:, :j] @ h
            ata = ata - back[:, :j] @ h
            left = square - h @ h
            if np.abs(h).max(initial=0) ** 2 <= AGAIN**2 * max(square, 0) or left <= (1e-12 * scale) ** 2:
                break
        alpha = float(np.sqrt(max(left, 0.0)))
        scale = max(scale, alpha)
        if alpha <= 1e-12 * scale or not alpha:
            b[j, j], beta = 0.0, 0.0  # A v lies in the span of the earlier u
            if j + 1 < steps:
                v = fresh(j + 1)
            continue
        b[j, j] = alpha
        w_all[:, j], back[:, j] = w / alpha, ata / alpha
        if j + 1 < steps:
            v = back[:, j] - alpha * v_all[:, j]
            for _ in range(2):
                v -= v_all[:, :j + 1] @ (v_all[:, :j + 1].T @ v)
            beta = float(np.linalg.norm(v))
            if beta <= 1e-12 * scale:
                beta, v = 0.0, fresh(j + 1)
            else:
                v /= beta
            b[j, j + 1] = beta
    return v_all, b, passes


def fit(table: DataFrame, dims: int, components: int = COMPONENTS, steps: int | None = None, seed: int = 5) -> Whitening | None:
    """Components of the distinct vectors of ``table`` (column x); None if there is nothing to whiten."""
    if not dims:
        return None
    blocks = _blocks(table, dims)
    n, sums, squares = _moments(blocks, dims)
    spread = n * squares - sum(int(s) ** 2 for s in sums)  # n^2 times the trace, exact
    if not spread:
        return None
    steps = dims if steps is None else min(steps, dims)
    v, b, passes = bidiagonalise(blocks, dims, n, sums, steps, seed)
    _, sigma, q = np.linalg.svd(b)
    keep = int((sigma[:components] > ZERO * sigma[0]).sum())
    vectors = v @ q[:keep].T
    vectors /= np.linalg.norm(vectors, axis=0)
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[top, np.arange(keep)])
    model = Whitening(dims, n, sums, vectors, sigma[:keep] ** 2 / n, spread / n / n, passes=passes)

    def covariance(x: np.ndarray) -> np.ndarray:
        y = whitened(_centred(x, n, sums), model)
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    got = _totals(blocks, dims, keep * (keep + 1), covariance)
    mean = got[keep * keep:] / n
    c = got[:keep * keep].reshape(keep, keep) / n - np.outer(mean, mean)
    model.identity_error = float(np.abs(c - np.eye(keep)).max())
    return model


def whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    return centred @ model.vectors / np.sqrt(model.values)


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exact."""
    far = model.n * x.astype(object) - model.sums if model.n * int(np.abs(x).max(initial=0)) >= 2**61 else model.n * x.astype(np.int64) - model.sums.astype(np.int64)
    about = (far.astype(np.float64) ** 2).sum(axis=1)
    if about.max(initial=0) < 2**62:
        return (far * far).sum(axis=1).tolist()
    return [s if (s := sum(int(c) ** 2 for c in row)) < 2**63 else None for row in far]


def whiten(df: DataFrame, components: int = COMPONENTS, steps: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
           seed: int = 5) -> DataFrame:
    """A row for each row that takes part and each component: id, component, n, deviation, whitened, explained, identity_error."""
    table, dims = coded(narrow(df, row_id=id_col, vector=vec_col), ["row_id"], "vector", FACTOR, name="whitening")
    model = fit(table, dims, components, steps, seed)
    schema = T.StructType([T.StructField("row_id", df.schema[id_col].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("row_id", id_col)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        x = matrix(batch.column("x"), "<i4", dims)
        k = len(model.values)
        y = whitened(_centred(x, model.n, model.sums), model)
        rows = pa.array(np.repeat(np.arange(len(x)), k))
        yield {"row_id": batch.column("row_id").take(rows), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
               "n": np.full(len(x) * k, model.n), "deviation": pa.array(_deviations(x, model), pa.int64()).take(rows), "whitened": y.ravel(),
               "explained": np.tile(model.values / model.trace, len(x)), "identity_error": np.full(len(x) * k, model.identity_error)}

    return map_arrow(table, work, schema).withColumnRenamed("row_id", id_col)
