"""Gradient boosting as a resumable loop over regression trees (M1, M3), trees as a table (M7).

The prediction starts at the mean of the training labels; each round fits one
``DecisionTreeRegressor`` to what is left of the labels and adds ``rate`` times its output, the first
tree like all others. The error on training and validation rows is read after every tree, and
the patience rule looks at it after every tree, so nothing is grown twice and at most ``patience`` trees
are grown in vain. Trees are grown in stages. Within a stage the rows of its start, with their
prediction so far, lie in one Parquet table; a round's residuals are that prediction plus the stage's own
trees, evaluated together, so neither the plan nor the lineage grows with the rounds. At the end
of a stage three tables are written under ``path``: the rows with their new prediction, the
stage's trees as nodes, and its errors, these last. A run on a path with whole stages goes on after
the last of them; a lost executor costs the part of one round.

Nodes are plain rows (tree, node, feature, threshold, categories, left, right, value): ``value`` is already
multiplied by the rate, an inner node sends a row to ``left`` if its feature is at most ``threshold``, or
if ``categories`` is given and holds it, else to ``right``; a leaf has neither. ``score`` adds up the first k trees in
one pass over the rows, whatever k is. The nodes of a model are at most trees * (2^(depth + 1) - 1) rows
(checked), which is what a task gets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import scratch_path

#: Rows that one task of a training table gets at least: every tree costs some ten jobs, so small tasks are mostly overhead.
TASK_ROWS = 65_536
#: Most nodes of a model that are sent to tasks.
MOST_NODES = 2_000_000

NODE_SCHEMA = "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, value double"


@dataclass
class BoostedTrees:
    """Start value, rate, errors after each tree and the folder of the stages."""

    path: str
    base: float
    rate: float
    train_errors: list[float] = field(default_factory=list)
    val_errors: list[float] = field(default_factory=list)
    keep: int = 0

    @property
    def trees(self) -> int:
        return len(self.train_errors)

    def nodes(self, spark: SparkSession, k: int | None = None) -> DataFrame:
        """The node table of the first k trees (default: those to keep)."""
        k = self.keep if k is None else k
        if not self.trees:
            return spark.createDataFrame([], NODE_SCHEMA)
        return spark.read.schema(NODE_SCHEMA).parquet(*[f"{self.path}/{s}/nodes" for s in stages(spark, self.path)]).where(F.col("tree") < k)


def best_iteration(errors: list[float], patience: int) -> int:
    """Number of trees to keep: first minimum of the validation error, scanning until
    ``patience`` rounds pass without improvement (the callback rule of the reference)."""
    best, best_i = math.inf, 0
    for i, e in enumerate(errors):
        if e < best:
            best, best_i = e, i
        elif i - best_i >= patience:
            break
    return best_i + 1


# ------------------------------------------------------------------ folders of a run
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def stages(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole stages of a run, in order: those whose errors are written."""
    out = []
    while _exists(spark, f"{path}/stage-{len(out):04d}/errors/_SUCCESS"):
        out.append(f"stage-{len(out):04d}")
    return out


# ------------------------------------------------------------------ trees
def ensemble(spark: SparkSession, trees: list, rate: float) -> GBTRegressionModel:
    """The sum of ``rate`` times each tree as one model."""
    sc, jvm = spark.sparkContext, spark._jvm
    models = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = sc._gateway.new_array(jvm.double, len(trees))
    for i, t in enumerate(trees):
        models[i], weights[i] = t._java_obj, float(rate)
    out = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"stage_{len(trees)}", models, weights))
    return out.setFeaturesCol("_features").setPredictionCol("_sum")


def node_table(spark: SparkSession, trees: list, rate: float, first: int, path: str) -> DataFrame:
    """The trees as node rows, numbered from ``first``; ``path`` takes Spark's own files of the model."""
    ensemble(spark, trees, rate).write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    n, leaf = F.col("nodeData"), F.col("nodeData.leftChild") < 0
    categorical = n["split"]["numCategories"] >= 0
    return saved.select(
        (F.col("treeID") + first).alias("tree"), n["id"].alias("node"), F.when(~leaf, n["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf & ~categorical, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(~leaf & categorical, n["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(~leaf, n["leftChild"]).alias("left"), F.when(~leaf, n["rightChild"]).alias("right"),
        F.when(leaf, n["prediction"] * F.lit(float(rate))).alias("value"))


class Forest:
    """A node table in flat arrays; ``predict`` sends all rows down all trees together."""

    def __init__(self, rows: list) -> None:
        rows = sorted(rows, key=lambda r: (r.tree, r.node))
        at = {(r.tree, r.node): i for i, r in enumerate(rows)}
        trees = sorted({r.tree for r in rows})
        inner = [r.left is not None for r in rows]
        self.roots = np.array([at[t, 0] for t in trees], dtype=np.int64)
        self.feature = np.array([r.feature if i else 0 for r, i in zip(rows, inner)], dtype=np.int64)
        self.threshold = np.array([r.threshold if r.threshold is not None else math.nan for r in rows])
        self.left = np.array([at[r.tree, r.left] if i else k for k, (r, i) in enumerate(zip(rows, inner))], dtype=np.int64)
        self.right = np.array([at[r.tree, r.right] if i else k for k, (r, i) in enumerate(zip(rows, inner))], dtype=np.int64)
        self.value = np.array([r.value if r.value is not None else 0.0 for r in rows])
        sets = [np.array(r.categories, dtype=np.int64) if r.categories is not None else None for r in rows]
        widest = max((int(s.max()) + 1 for s in sets if s is not None and len(s)), default=0)
        self.is_set = np.array([s is not None for s in sets], dtype=bool)
        self.members = np.zeros((len(rows), widest + 1), dtype=bool)  # the last column: every larger category
        for i, s in enumerate(sets):
            if s is not None:
                self.members[i, s] = True

    def predict(self, x: np.ndarray, block: int = 1024) -> np.ndarray:
        out = np.zeros(len(x))
        for lo in range(0, len(x) if len(self.roots) else 0, block):
            part = x[lo:lo + block]
            row = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            while True:
                v = part[row, self.feature[at]]
                left = v <= self.threshold[at]
                if self.is_set.any():
                    cat = np.clip(np.nan_to_num(v), 0, self.members.shape[1] - 1).astype(np.int64)
                    left = np.where(self.is_set[at], self.members[at, cat], left)
                to = np.where(left, self.left[at], self.right[at])
                if (to == at).all():
                    break
                at = to
            for j in range(at.shape[1]):  # tree by tree, as a plain loop would add them
                out[lo:lo + block] += self.value[at[:, j]]
        return out


def score(nodes: DataFrame, features: Column, base: float = 0.0, most_nodes: int = MOST_NODES) -> Column:
    """``base`` plus the sum of all trees of ``nodes`` on an array column of features, in one pass."""
    n = nodes.count()
    if n > most_nodes:
        raise ValueError(f"{n} nodes, more than {most_nodes}")
    forest = Forest(nodes.collect())  # checked just above

    @F.arrow_udf("double")
    def predict(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
        return pa.array(base + forest.predict(x))

    return predict(features)


# ------------------------------------------------------------------ training
def training_tasks(rows: int) -> int:
    """Tasks that a training table of so many rows is read in, at most."""
    return max(1, -(-rows // TASK_ROWS))


def _rounds(rows: DataFrame, spark: SparkSession, trees: list, rate: float) -> DataFrame:
    """The rows with the prediction after ``trees`` more than their own, and the residual."""
    now = F.col("_at")
    if trees:
        rows, now = ensemble(spark, trees, rate).transform(rows), F.col("_at") + F.col("_sum")
    return rows.select("_features", "_label", "is_val", now.alias("_at")).withColumn("_rest", F.col("_label") - F.col("_at"))


def _errors(rows: DataFrame) -> tuple[float, float | None]:
    """Mean squared residual of training and validation rows (None without any)."""
    square = F.col("_rest") * F.col("_rest")
    r = rows.agg(F.avg(F.when(~F.col("is_val"), square)).alias("t"), F.avg(F.when(F.col("is_val"), square)).alias("v")).first()
    return r.t, r.v


def boost(rows: DataFrame, trees: int, rate: float, patience: int | None, depth: int = 5, max_bins: int = 256, min_rows: int = 20, seed: int = 42,
          stage_trees: int = 25, path: str | None = None) -> BoostedTrees:
    """Grow up to ``trees`` trees on ``rows`` (_features, _label, is_val); with a ``patience`` the
    validation rows decide when to stop and how many trees to keep. ``path``: a folder that all executors
    share; whole stages found there are not grown again."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, "boost")
    done = stages(spark, path)
    if not done:
        first = rows.where(~F.col("is_val")).agg(F.avg("_label").alias("m"), F.count("*").alias("n")).first()
        n = rows.count()
        start = rows.select("_features", F.col("_label").cast("double").alias("_label"), "is_val", F.lit(float(first.m)).alias("_at"))
        start.coalesce(training_tasks(n)).write.mode("overwrite").parquet(f"{path}/start/rows")
    state = f"{path}/{done[-1] if done else 'start'}/rows"
    model = BoostedTrees(path, 0.0, rate)
    for s in done:
        for r in spark.read.parquet(f"{path}/{s}/errors").orderBy("tree").collect():  # stage_trees rows
            model.base = r.base
            model.train_errors.append(r.train_error), model.val_errors.append(r.val_error)
    if not done:
        model.base = float(first.m)

    def stopped() -> bool:
        return patience is not None and bool(model.trees) and model.trees - best_iteration(model.val_errors, patience) >= patience

    learner = DecisionTreeRegressor(featuresCol="_features", labelCol="_rest", predictionCol="_tree", maxDepth=depth, maxBins=max_bins, minInstancesPerNode=min_rows, seed=seed)
    while model.trees < trees and not stopped():
        start = spark.read.parquet(state)
        grown, begin, now = [], model.trees, _rounds(start, spark, [], rate).persist()
        while len(grown) < stage_trees and model.trees < trees and not stopped():
            grown.append(learner.fit(now.where(~F.col("is_val"))))
            after = _rounds(start, spark, grown, rate).persist()
            train_error, val_error = _errors(after)
            model.train_errors.append(train_error), model.val_errors.append(val_error)
            now.unpersist()
            now = after
        stage = f"{path}/stage-{len(done):04d}"
        now.drop("_rest").write.mode("overwrite").parquet(f"{stage}/rows")
        now.unpersist()
        node_table(spark, grown, rate, begin, f"{stage}/model").coalesce(1).write.mode("overwrite").parquet(f"{stage}/nodes")
        _remove(spark, f"{stage}/model")
        errors = [(begin + i, model.base, model.train_errors[begin + i], model.val_errors[begin + i]) for i in range(len(grown))]
        spark.createDataFrame(errors, "tree int, base double, train_error double, val_error double").coalesce(1).write.mode("overwrite").parquet(f"{stage}/errors")
        _remove(spark, state)  # the stage is whole: its own rows are all that is needed
        done.append(stage.rsplit("/", 1)[1])
        state = f"{stage}/rows"
    model.keep = best_iteration(model.val_errors, patience) if patience is not None and model.trees else model.trees
    return model


def feature_array(column: str = "_features") -> Column:
    """A vector column as an array, for ``score``."""
    return vector_to_array(F.col(column))
