"""Boosting loop, node table and out-of-fold encodings against plain loops and SQL."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tillcast.operators import boosting
from tillcast.plans import forecast

PARAMS = dict(trees=7, rate=0.3, depth=3, max_bins=32, min_rows=5, seed=1)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(0, 900).select((F.rand(1) * 10).alias("a"), F.round(F.rand(2) * 4).alias("b"), (F.col("id") % 11).cast("string").alias("c"), (F.col("id") % 6 == 0).alias("is_val"))
    df = df.withColumn("_label", F.col("a") * 2 + F.sin("b") * 3 + F.col("c").isin("2", "5", "7").cast("int") * 6)
    df = StringIndexer(inputCol="c", outputCol="ci", handleInvalid="keep").fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "ci"], outputCol="_features").transform(df).select("_features", "_label", "is_val").repartition(2).persist()


def plain_loop(rows, trees, rate, depth, max_bins, min_rows, seed):
    """(base, predictions after each tree on all rows): one tree at a time, summed in Python."""
    train = rows.where("not is_val")
    base = train.agg(F.avg("_label")).first()[0]
    x = rows.select("_features", "_label", "is_val").toPandas()
    at, out = np.full(len(x), base), []
    for _ in range(trees):
        now = _with_rest(rows, x, at)
        tree = DecisionTreeRegressor(featuresCol="_features", labelCol="_rest", maxDepth=depth, maxBins=max_bins, minInstancesPerNode=min_rows, seed=seed).fit(now.where("not is_val"))
        at = at + rate * np.array([tree.predict(f) for f in x._features])
        out.append(at.copy())
    return base, x, out


def _with_rest(rows, x, at):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("_features", VectorUDT()), T.StructField("_rest", T.DoubleType()), T.StructField("is_val", T.BooleanType())])
    df = rows.sparkSession.createDataFrame([(f, float(y - p), bool(v)) for f, y, v, p in zip(x._features, x._label, x.is_val, at)], schema)
    return df.withMetadata("_features", rows.schema["_features"].metadata)  # which features are categories


def scored(model, spark, rows, k):
    return rows.select("_features", boosting.score(model.nodes(spark, k), boosting.feature_array(), model.base).alias("p")).toPandas()


@pytest.fixture(scope="module")
def model(spark, rows, tmp_path_factory):
    return boosting.boost(rows, patience=30, stage_trees=3, path=str(tmp_path_factory.mktemp("m") / "run"), **PARAMS)


def test_first_k_trees_equal_a_plain_loop(spark, rows, model):
    base, x, steps = plain_loop(rows, **PARAMS)
    assert model.base == pytest.approx(base) and model.trees == 7 and model.keep > 1
    val = x.is_val.to_numpy(bool)
    for k in (1, 3, 4, 7):
        got = scored(model, spark, rows, k)
        assert np.allclose(got.p, steps[k - 1], atol=1e-9)
        assert model.val_errors[k - 1] == pytest.approx(((x._label - steps[k - 1])[val] ** 2).mean())
        assert model.train_errors[k - 1] == pytest.approx(((x._label - steps[k - 1])[~val] ** 2).mean())
    assert all(b < a for a, b in zip(model.train_errors, model.train_errors[1:]))


def test_every_tree_is_shrunk_from_the_mean(rows, model):
    """A tree explains at most all that is left: with rate r its first share leaves (1 - r)^2 at least."""
    variance = rows.where("not is_val").agg(F.var_pop("_label")).first()[0]
    assert 0.7 ** 2 * variance <= model.train_errors[0] < variance
    assert model.keep == boosting.best_iteration(model.val_errors, 30)


def test_a_stopped_run_goes_on_from_its_last_whole_stage(spark, rows, model, tmp_path):
    path = str(tmp_path / "run")
    half = dict(PARAMS, trees=5)
    first = boosting.boost(rows, patience=30, stage_trees=3, path=path, **half)
    assert first.trees == 5 and boosting.stages(spark, path) == ["stage-0000", "stage-0001"]
    # without its errors the second stage does not count
    os.remove(f"{path}/stage-0001/errors/_SUCCESS")
    assert boosting.stages(spark, path) == ["stage-0000"]
    # go on from a path whose stages are whole
    path = str(tmp_path / "other")
    boosting.boost(rows, patience=30, stage_trees=3, path=path, **dict(PARAMS, trees=3))
    jobs = {p.name for p in (tmp_path / "other" / "stage-0000" / "nodes").iterdir()}
    again = boosting.boost(rows, patience=30, stage_trees=3, path=path, **PARAMS)
    assert {p.name for p in (tmp_path / "other" / "stage-0000" / "nodes").iterdir()} == jobs  # not grown again
    assert again.trees == 7 and again.base == model.base
    assert np.allclose(again.val_errors, model.val_errors) and np.allclose(scored(again, spark, rows, 7).p, scored(model, spark, rows, 7).p)
    assert not (tmp_path / "other" / "start" / "rows").exists() and not (tmp_path / "other" / "stage-0000" / "rows").exists()


def test_patience_is_read_after_every_tree(spark, tmp_path):
    """Labels without any signal: growing ends ``patience`` trees after the best."""
    df = spark.range(0, 600).select(F.rand(3).alias("a"), F.rand(4).alias("_label"), (F.col("id") % 3 == 0).alias("is_val"))
    df = VectorAssembler(inputCols=["a"], outputCol="_features").transform(df).select("_features", "_label", "is_val")
    m = boosting.boost(df, trees=40, rate=0.5, patience=4, depth=4, max_bins=32, min_rows=2, stage_trees=3, path=str(tmp_path / "r"))
    assert m.trees == m.keep + 4 and m.trees < 40
    assert boosting.boost(df, trees=3, rate=0.5, patience=None, path=str(tmp_path / "s")).keep == 3


NODE_SQL = """
WITH RECURSIVE x AS (SELECT * FROM read_parquet('{rows}/*.parquet')),
n AS (SELECT * FROM read_parquet({nodes}) WHERE tree < {k}),
walk AS (SELECT x.id, n.tree, n.node, x.f, n.feature, n.threshold, n.categories, n."left" AS l, n."right" AS r, n.value FROM x, n WHERE n.node = 0
  UNION ALL
  SELECT w.id, n.tree, n.node, w.f, n.feature, n.threshold, n.categories, n."left", n."right", n.value FROM walk w JOIN n ON n.tree = w.tree
   AND n.node = CASE WHEN CASE WHEN w.categories IS NULL THEN w.f[w.feature + 1] <= w.threshold ELSE list_contains(w.categories, w.f[w.feature + 1]) END THEN w.l ELSE w.r END
  WHERE w.l IS NOT NULL)
SELECT id, {base}::DOUBLE + sum(value) AS p FROM walk WHERE l IS NULL GROUP BY id ORDER BY id
"""


@pytest.mark.parametrize("k", [1, 5, 7])
def test_sql_walks_the_written_node_table_to_the_same_scores(spark, rows, model, tmp_path, k):
    named = rows.withColumn("id", F.monotonically_increasing_id()).withColumn("f", boosting.feature_array())
    named.select("id", "f").write.parquet(str(tmp_path / "x"))
    nodes = [f"{model.path}/{s}/nodes/*.parquet" for s in boosting.stages(spark, model.path)]
    sql = duckdb.sql(NODE_SQL.format(rows=tmp_path / "x", nodes=nodes, k=k, base=model.base)).fetchall()
    got = {r.id: r.p for r in spark.read.parquet(str(tmp_path / "x")).select("id", boosting.score(model.nodes(spark, k), F.col("f"), model.base).alias("p")).collect()}
    assert len(sql) == 900 and all(math.isclose(got[i], p, abs_tol=1e-9) for i, p in sql)


def test_some_split_is_by_category(spark, model):
    assert model.nodes(spark, 7).where("categories is not null").count() > 0
    plan = spark.range(4).select(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)).alias("f"))
    text = plan.select(boosting.score(model.nodes(spark, 7), F.col("f")))._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1  # one pass, whatever the number of trees


def test_score_without_trees_or_rows(spark):
    none = spark.createDataFrame([], boosting.NODE_SCHEMA)
    df = spark.range(3).select(F.array(F.lit(1.0)).alias("f"))
    assert [r.p for r in df.select(boosting.score(none, F.col("f"), 2.5).alias("p")).collect()] == [2.5] * 3
    assert df.where("f is null").select(boosting.score(none, F.col("f"), 2.5).alias("p")).collect() == []
    with pytest.raises(ValueError, match="nodes"):
        boosting.score(spark.createDataFrame([(0, 0, None, None, None, None, None, 1.0)] * 3, boosting.NODE_SCHEMA), F.col("f"), most_nodes=2)


def test_encodings_leave_a_rows_own_fold_out(spark):
    data = [("A", "x", 10.0), ("A", "y", 20.0), ("A", "x", 30.0), ("B", None, 40.0), ("B", "x", 50.0), ("C", "z", 60.0), ("A", None, None)]
    df = spark.createDataFrame([(k, h, y, i % 3) for i, (k, h, y) in enumerate(data)], "atm_id string, holiday_name string, t double, _fold int").withColumn("n", F.monotonically_increasing_id())
    tables, mu, card = forecast.fit_target_encodings_by_fold(df, ["atm_id", "holiday_name"], ["t"], 2.0, 1000)
    assert mu["t"] == 35.0 and card == {"atm_id": 3, "holiday_name": 4}
    rows = [r.asDict() for r in forecast.apply_encodings_by_fold(df, tables, mu).collect()]
    assert len(rows) == len(data)

    def mean(c, value, fold):
        rest = [r["t"] for r in rows if r["_fold"] != fold and r["t"] is not None]
        own = [r["t"] for r in rows if r["_fold"] != fold and r["t"] is not None and r[c] == value]
        return (sum(own) + 2.0 * sum(rest) / len(rest)) / (len(own) + 2.0)

    for r in rows:
        for c in ("atm_id", "holiday_name"):
            assert r[f"_enc_{c}_t"] == pytest.approx(mean(c, r[c], r["_fold"]))
    # another target of the same row changes no encoding of that row
    changed = df.withColumn("t", F.when((F.col("atm_id") == "B") & F.col("holiday_name").isNull(), 9999.0).otherwise(F.col("t")))
    tables, mu, _ = forecast.fit_target_encodings_by_fold(changed, ["atm_id", "holiday_name"], ["t"], 2.0, 1000)
    after = [r for r in forecast.apply_encodings_by_fold(changed, tables, mu).collect() if r.t == 9999.0][0]
    before = [r for r in rows if r["atm_id"] == "B" and r["holiday_name"] is None][0]
    assert after["_enc_atm_id_t"] == before["_enc_atm_id_t"] and after["_enc_holiday_name_t"] == before["_enc_holiday_name_t"]
    # rows outside the training folds, and values that training never saw
    new = spark.createDataFrame([("A", "q", forecast.NO_FOLD), (None, "x", forecast.NO_FOLD)], "atm_id string, holiday_name string, _fold int")
    got = sorted([(r["_enc_atm_id_t"], r["_enc_holiday_name_t"]) for r in forecast.apply_encodings_by_fold(new, *forecast.fit_target_encodings_by_fold(df, ["atm_id", "holiday_name"], ["t"], 2.0, 1000)[:2]).collect()])
    assert got == sorted([((60 + 70) / 5, 35.0), (35.0, (90 + 70) / 5)])
