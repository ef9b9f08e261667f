"""Whitening against a dense eigendecomposition, hard negatives against all pairs."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tillcast.llm import negatives as ng
from tillcast.llm import whitening as wh
from tillcast.llm.vectors import exact

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"vec_id {kind}, embedding array<double>, label int").withColumn("row_id", F.lit("clash")).withColumn("x", F.lit(1)).withColumn("vector", F.lit(2.0))


def test_exact_vectors_leave_out_what_is_no_number():
    rows = [[0.5, -0.001], None, [], [None, 1.0], [NAN, 1.0], [1.0, INF], [1e300, 0.0], [3.0], [0.999, 2.0]]
    at, lengths, flat = exact(pa.array(rows, pa.list_(pa.float64())), 64)
    assert at.tolist() == [0, 7, 8] and lengths.tolist() == [2, 1, 2] and flat.tolist() == [32, -1, 192, 63, 128]
    for sliced in (pa.array(rows, pa.list_(pa.float32())).slice(4, 5), pa.array([], pa.list_(pa.float64()))):
        at, _, flat = exact(sliced, 64)
        assert at.tolist() == ([3, 4] if len(sliced) else [])


# ------------------------------------------------------------------ whitening
def dense(x, k=16):
    """(n, deviations, eigenvalues, eigenvectors, trace) by plain numpy over the distinct rows."""
    x = np.asarray(x, dtype=object) + 1_000_000
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    dev = [int(((n * r - sums) ** 2).sum()) for r in x]
    c = ((n * fit - sums) / n).astype(float)
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    return n, dev, e[::-1][:k], q[:, ::-1][:, :k], np.trace(v), ((n * x - sums) / n).astype(float)


def matrix_of(out, ids, column="whitened"):
    return out.pivot(index="vec_id", columns="component", values=column).loc[ids].to_numpy()


def test_whitening_equals_a_dense_decomposition(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = df.toPandas()
    out = wh.whiten(df).toPandas()
    x = np.floor(64 * np.array(rows.embedding.tolist(), dtype=float)).astype(int)
    n, dev, e, q, trace, centred = dense(x)
    got = matrix_of(out, rows.vec_id)
    want = centred @ q / np.sqrt(e)
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-9
    one = out.drop_duplicates("vec_id").set_index("vec_id").loc[rows.vec_id]
    assert (one.n == n).all() and one.deviation.tolist() == dev
    first = out.drop_duplicates("component").sort_values("component")
    assert first.component.tolist() == list(range(1, 17)) and np.allclose(first.explained, e / trace, rtol=1e-12)
    assert out.identity_error.nunique() == 1 and 0 <= out.identity_error[0] < 1e-9


def test_bidiagonalisation_is_one_of_the_centred_matrix(spark):
    """V orthonormal, A V = U B with U orthonormal, B upper bidiagonal: B'B = V'A'A V."""
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (300, 9)) * np.array([1, 40, 1, 1, 5, 1, 1, 1, 9])
    table, dims = wh.coded(frame(spark, [(i, (r / 64).tolist(), 0) for i, r in enumerate(x)]).select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vector")), ["row_id"], "vector", 64)
    blocks = wh._blocks(table, dims)
    n, sums, squares = wh._moments(blocks, dims)
    assert n == len(np.unique(x, axis=0)) and sums.tolist() == np.unique(x, axis=0).sum(axis=0).tolist() and squares == (np.unique(x, axis=0) ** 2).sum()
    v, b, passes = wh.bidiagonalise(blocks, dims, n, sums, dims)
    assert np.allclose(v.T @ v, np.eye(dims), atol=1e-13) and np.allclose(b, np.triu(np.tril(b, 1)))
    a = np.unique(x, axis=0) - np.unique(x, axis=0).mean(axis=0)
    scale = np.abs(a.T @ a).max()
    assert np.allclose(b.T @ b / scale, v.T @ (a.T @ a) @ v / scale, atol=1e-12) and dims <= passes <= 3 * dims


@pytest.mark.parametrize("case", ["constant dimension", "equal eigenvalues", "few rows", "repeated rows", "far offset"])
def test_whitening_of_degenerate_tables(spark, case):
    rng = np.random.default_rng(4)
    x = rng.integers(-30, 30, (200, 5)).astype(float)
    if case == "constant dimension":
        x[:, 2], x[:, 4] = 7, x[:, 0] + x[:, 1]
    elif case == "equal eigenvalues":
        x = np.array([[s * 4 * (i == j) for j in range(5)] for i in range(5) for s in (1, -1)])
    elif case == "few rows":
        x = x[:3]
    elif case == "repeated rows":
        x = np.r_[x, np.repeat(x[:1], 400, axis=0)]
    else:
        x = x + 9_000_000
    out = wh.whiten(frame(spark, [(i, (r / 64).tolist(), 0) for i, r in enumerate(x)])).toPandas()
    n, dev, e, q, trace, centred = dense(x.astype(int))
    k = int((e > 1e-9 * e[0]).sum())
    y = matrix_of(out, list(range(len(x))))
    assert y.shape == (len(x), k) and out.n[0] == n
    assert out.drop_duplicates("vec_id").sort_values("vec_id").deviation.tolist() == dev
    assert np.allclose(out.drop_duplicates("component").sort_values("component").explained, e[:k] / trace, rtol=1e-9)
    # whatever the basis: the whitened rows have the geometry of the centred ones under the inverse covariance
    inverse = np.linalg.pinv(q[:, :k] * e[:k] @ q[:, :k].T)
    assert np.allclose(y @ y.T, centred @ inverse @ centred.T, atol=1e-7) and out.identity_error[0] < 1e-9


def test_whitening_of_odd_rows(spark):
    good = [(i, [0.1 * i, -0.3 * i * i, 1.0 / (i + 1)], None) for i in range(6)]
    odd = [(10, None, 1), (11, [], 1), (12, [1.0, None, 2.0], 1), (13, [NAN, 1.0, 1.0], 1), (14, [INF, 1.0, 1.0], 1), (15, [1.0, 2.0], 1), (None, good[2][1], 3), (3, good[3][1], 4)]
    out = wh.whiten(frame(spark, good + odd)).toPandas()
    assert sorted(out.vec_id.dropna().unique()) == [0, 1, 2, 3, 4, 5] and out.n[0] == 6
    k = out.component.max()
    assert len(out) == 8 * k and len(out[out.vec_id == 3]) == 2 * k and out.vec_id.isna().sum() == k
    same = frame(spark, [(i, [1.0, 2.0], 0) for i in range(4)])
    for table in (same, frame(spark, odd[:3]), frame(spark, [])):
        got = wh.whiten(table)
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_64_bits():
    model = wh.Whitening(2, 10**7, np.array([0, 0], dtype=object), np.eye(2), np.ones(2), 2.0)
    assert wh._deviations(np.array([[3, 4], [10**6, 0], [100, 0]]), model) == [25 * 10**14, None, 10**18]


# ------------------------------------------------------------------ hard negatives
def brute(rows, every=50, relabel=7):
    """All scores, sorted."""
    rows = [(i, v, y) for i, v, y in rows if i is not None and y is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    rows = [(i, [math.floor(256 * c) for c in v], (y + 1) % 10 if i % relabel == 0 else y) for i, v, y in rows]
    out = []
    for a, v, y in rows:
        if a % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, w)), i, z) for i, w, z in rows if i != a))
        for s, p, _ in [x for x in scored if x[2] == y][:5]:
            hard = [x for x in scored if x[2] != y and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(hard)]
    return sorted(out)


def mined(spark, rows, **kw):
    got = ng.mine(frame(spark, rows), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def table(seed, n, d, scale=0.15, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, scale, (clusters, d))
    return [(i, (centres[rng.integers(clusters)] + rng.normal(0, scale, d)).tolist(), int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("d,scale", [(64, 0.15), (7, 0.5), (1, 1.0), (33, 300.0), (130, 20.0)])
def test_negatives_equal_brute_force(spark, monkeypatch, d, scale):
    monkeypatch.setattr(ng, "ROWS", 64)
    monkeypatch.setattr(ng, "ANCHORS", 3)
    rows = table(d, 400, d, scale)
    assert mined(spark, rows) == brute(rows)


def test_negatives_in_one_task_and_in_many(spark, monkeypatch):
    rows = table(9, 500, 16)
    want = brute(rows, every=5)
    for pairs, spread, block in ((1 << 32, 1, 4096), (2000, 1, 40)):
        monkeypatch.setattr(ng, "TASK_PAIRS", pairs), monkeypatch.setattr(ng, "SPREAD", spread), monkeypatch.setattr(ng, "ROWS", block)
        monkeypatch.setattr(ng, "ANCHORS", 8)
        assert mined(spark, rows, anchor_every=5) == want


def test_negatives_with_ties_hot_label_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(0, 2, 6)], 1 if i % 3 else int(rng.integers(9))) for i in range(300)]
    rows += [(1000, None, 1), (1050, [0.5] * 6, None), (None, [0.5] * 6, 1), (1100, [], 1), (1150, [NAN] * 6, 1), (1200, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (1250, [1.0] * 5, 2), (1300, [1.0] * 6, 77)]
    assert mined(spark, rows) == brute([r for r in rows if r[0] != 1250])
    assert mined(spark, []) == [] and mined(spark, rows[300:305]) == [] and mined(spark, [(1, [1.0], 1)]) == []
    zero = [(50, [0.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (100, [-1.0, 0.0], 3), (3, [1.0, 1.0], 3), (4, [-1.0, 0.5], 2)]
    assert mined(spark, zero) == brute(zero)


def test_repeated_rows_fill_places(spark):
    rows = [(50, [1.0, 0.0], 1)] * 2 + [(1, [0.9, 0.1], 1)] * 3 + [(2, [0.6, 0.0], 2)] * 2 + [(3, [0.5, 0.0], 2)]
    got = mined(spark, rows)
    assert len(got) == 2 * 3 * 3 and {g[1] for g in got} == {1} and sorted(g[3] for g in got) == [2] * 12 + [3] * 6


def test_bounds_hold_and_refine():
    """Every level's bounds enclose the scores; finer segments are at least as tight up to rounding."""
    rng = np.random.default_rng(7)
    x, y = rng.integers(-200, 200, (40, 50)), (rng.integers(-20, 20, (30, 50)) + 90)
    a, b = (ng.Side(np.arange(len(v)), np.zeros(len(v), int), v, *ng._summary(v)) for v in (x, y))
    exact_ = x @ y.T
    widths = []
    assert len(a.levels) >= 2 and a.levels[0][0].shape[1] < a.levels[-1][0].shape[1] == 13
    for (ma, sa), (mb, sb) in zip(a.levels, b.levels):
        mid, off = ma @ mb.T, sa @ sb.T + ng.SLACK * np.outer(a.size, b.size)
        assert (mid - off <= exact_).all() and (exact_ <= mid + off).all()
        widths.append(off.mean())
    assert widths == sorted(widths, reverse=True)
    rows, cols, scores = ng.candidates(a, b, np.arange(40), np.arange(30), np.full(40, exact_.max(), np.float32), np.full(40, np.inf, np.float32))
    assert exact_.max() in scores and scores.size < exact_.size and (scores == exact_[np.ix_(rows, cols)]).all()


def test_first_places_without_room_for_a_key():
    big = np.array([[1 << 60, (1 << 60) - 1, 1 << 60, 5]])
    s, i = ng._first(big, np.array([[True, True, True, False]]), np.array([3, 5, 7, 9]), 2)
    assert i.tolist() == [[3, 7]] and s.tolist() == [[1 << 60, 1 << 60]]
