"""Forecast plan (M1-M8) and the end-to-end job.

One global regressor per horizon (not per machine), trained with Spark ML on the
whole training set. The reference's leaf-wise booster with native categorical and
missing-value handling is re-expressed as:

* categorical inputs -> categorical tree splits for the columns named in ``nominal`` (state,
  holiday type, metadata tiers; a column with more values than ``max_bins`` is an error, not
  another model), and for all others (machine id, holiday name) smoothed target means
  computed on the training rows with a group-by and joined back (scales with the number
  of machines; no label array on the driver). A training row gets means over the other folds
  of the training rows, so its own target is in none of its inputs; validation rows and
  the rows to score get means over all training rows;
* missing numeric inputs -> 0 and a 0/1 indicator for each input that can be missing;
* boosting with early stopping -> ``operators.boosting``: start at the mean, every tree shrunk, the
  patience rule on the validation error after every tree, no refits, stages that a new run goes on from;
  the latest rows are scored from the node table of the trees to keep, in one pass. A horizon without
  early stopping takes all rounds in one fit of ``GBTRegressor``, whose first tree has weight 1.

The regressor is a parameter: any ``pyspark.ml`` estimator with a features, label and prediction
column takes the place of the loop; early stopping then applies to boosted trees only.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillcast.config import CATEGORICAL, ForecastConfig, V1
from tillcast.functions.numeric import postprocess_prediction
from tillcast.operators import boosting, panel
from tillcast.operators.boosting import best_iteration
from tillcast.operators.dataset import ensure_not_empty
from tillcast.operators.joins import bounded_broadcast, hold
from tillcast.session import cut_lineage

@dataclass
class HorizonRun:
    label: str
    target: str
    train_rows: int
    val_rows: int
    early_stopping: bool = False
    trees: int = 0  # to keep
    grown: int = 0
    val_rmse: float | None = None  # of the trees to keep
    mean_rmse: float | None = None  # of the training mean, on the same rows
    skipped: bool = False


@dataclass
class ForecastRun:
    max_date: object = None
    split_date: object = None
    cleaned_rows: int = 0
    horizons: list[HorizonRun] = field(default_factory=list)


def fit_target_encodings(train: DataFrame, cols: list[str], targets: list[str], smoothing: float,
                         broadcast_max_rows: int):
    """Smoothed target means of every categorical column for every horizon, in ONE
    aggregation (GROUPING SETS, one shuffle, partial aggregation before it).

    Returns ``{column: DataFrame(_k_<column>, _enc_<column>_<target>...)}`` (each table
    already wrapped for broadcast when its counted size allows) and the global mean of
    every target (the value for unseen or missing categories).
    """
    n = len(cols)
    aggs = []
    for t in targets:
        aggs += [F.sum(t).alias(f"_s_{t}"), F.count(t).alias(f"_n_{t}")]
    stats = train.groupingSets([[c] for c in cols] + [[]], *cols).agg(*aggs, F.grouping_id().alias("_gid"))
    stats = hold(stats)
    # one small job: the grand total and the size of every column's table
    sizes = {r["_gid"]: r["_rows"] for r in stats.groupBy("_gid").agg(F.count(F.lit(1)).alias("_rows")).collect()}
    total = stats.where(F.col("_gid") == (1 << n) - 1).first()
    mu = {t: (total[f"_s_{t}"] / total[f"_n_{t}"]) if total and total[f"_n_{t}"] else 0.0 for t in targets}
    tables = {}
    for i, c in enumerate(cols):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        enc = [((F.coalesce(F.col(f"_s_{t}"), F.lit(0.0)) + F.lit(smoothing * mu[t])) / (F.col(f"_n_{t}") + F.lit(smoothing)))
               .alias(f"_enc_{c}_{t}") for t in targets]
        table = stats.where(F.col("_gid") == gid).select(F.col(c).alias(f"_k_{c}"), *enc)
        tables[c], _ = bounded_broadcast(table, sizes.get(gid, 0), broadcast_max_rows)
    cardinality = {c: sizes.get((1 << n) - 1 - (1 << (n - 1 - i)), 0) for i, c in enumerate(cols)}
    return tables, mu, cardinality


#: The fold of rows that are in no training fold: they get means over all training rows.
NO_FOLD = -1


def encoding_fold(folds: int, is_val=None):
    """Fold of a row, fixed by its machine and date; ``NO_FOLD`` where ``is_val``."""
    key = F.concat_ws("|", F.col("atm_id").cast("string"), F.col("date").cast("string"))
    fold = F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")
    return fold if is_val is None else F.when(is_val, F.lit(NO_FOLD)).otherwise(fold)


def fit_target_encodings_by_fold(train: DataFrame, cols: list[str], targets: list[str], smoothing: float, broadcast_max_rows: int):
    """Smoothed target means out of fold, of all columns and horizons, in one aggregation (GROUPING SETS with
    the fold in every set). ``train`` has ``_fold``.

    Returns ``{column: DataFrame(_k_<column>, _f_<column>, _enc_<column>_<target>...)}``, the global mean of
    every target and the number of values of every column. The row of a value and a fold has the
    mean over the other folds, smoothed with their global mean; the row of ``NO_FOLD`` is over all.
    """
    n = len(cols)
    aggs = []
    for t in targets:
        aggs += [F.sum(t).alias(f"_s_{t}"), F.count(t).alias(f"_n_{t}")]
    # read by every table below; written once, in as few parts as its size asks for (a cached one keeps every shuffle partition)
    stats = cut_lineage(train.groupingSets([[c, "_fold"] for c in cols] + [["_fold"]], *cols, "_fold").agg(*aggs, F.grouping_id().alias("_gid")))
    gid = {c: ((1 << n) - 1 - (1 << (n - 1 - i))) << 1 for i, c in enumerate(cols)}
    sizes = {r["_gid"]: (r["_rows"], r["_values"]) for r in stats.groupBy("_gid").agg(  # n + 1 rows
        F.count(F.lit(1)).alias("_rows"), F.coalesce(*[F.when(F.col("_gid") == g, F.count_distinct(F.struct(c))) for c, g in gid.items()], F.lit(0)).alias("_values")).collect()} if cols else {}
    folds = stats.where(F.col("_gid") == ((1 << n) - 1) << 1).collect()  # a row for each fold
    total = {t: (sum(r[f"_s_{t}"] or 0.0 for r in folds), sum(r[f"_n_{t}"] for r in folds)) for t in targets}
    mu = {t: s / k if k else 0.0 for t, (s, k) in total.items()}
    tables, cardinality = {}, {}
    for c in cols:
        own = stats.where(F.col("_gid") == gid[c]).select(F.col(c).alias(f"_k_{c}"), F.col("_fold").alias(f"_f_{c}"), *[F.coalesce(f"_s_{t}", F.lit(0.0)).alias(f"_s_{t}") for t in targets],
                                                         *[f"_n_{t}" for t in targets])
        value = W.partitionBy(f"_k_{c}")  # a row for each fold
        others, whole = [], []
        for t in targets:
            rest_mean = F.lit(0.0)
            for r in folds:
                k = total[t][1] - r[f"_n_{t}"]
                rest_mean = F.when(F.col(f"_f_{c}") == r["_fold"], F.lit((total[t][0] - (r[f"_s_{t}"] or 0.0)) / k if k else 0.0)).otherwise(rest_mean)
            s, k = F.sum(f"_s_{t}").over(value) - F.col(f"_s_{t}"), F.sum(f"_n_{t}").over(value) - F.col(f"_n_{t}")
            others.append(((s + F.lit(smoothing) * rest_mean) / (k + F.lit(smoothing))).alias(f"_enc_{c}_{t}"))
            whole.append(((F.sum(f"_s_{t}") + F.lit(smoothing * mu[t])) / (F.sum(f"_n_{t}") + F.lit(smoothing))).alias(f"_enc_{c}_{t}"))
        table = own.select(f"_k_{c}", f"_f_{c}", *others).unionByName(own.groupBy(f"_k_{c}").agg(F.lit(NO_FOLD).alias(f"_f_{c}"), *whole))
        rows, cardinality[c] = sizes.get(gid[c], (0, 0))
        tables[c], _ = bounded_broadcast(table, 2 * rows, broadcast_max_rows)
    return tables, mu, cardinality


def apply_encodings_by_fold(df: DataFrame, tables: dict[str, DataFrame], mu: dict[str, float]) -> DataFrame:
    """LEFT JOIN each table on its value (NULL-safe) and the row's ``_fold``; unseen values get the global mean."""
    for c, t in tables.items():
        df = df.join(t, df[c].eqNullSafe(t[f"_k_{c}"]) & (df["_fold"] == t[f"_f_{c}"]), "left").drop(f"_k_{c}", f"_f_{c}")
        df = df.withColumns({f"_enc_{c}_{tg}": F.coalesce(F.col(f"_enc_{c}_{tg}"), F.lit(m)) for tg, m in mu.items()})
    return df


def apply_target_encodings(df: DataFrame, tables: dict[str, DataFrame], mu: dict[str, float]) -> DataFrame:
    """LEFT JOIN each encoding table, NULL-safe; unseen categories get the global mean."""
    for c, t in tables.items():
        df = df.join(t, df[c].eqNullSafe(t[f"_k_{c}"]), "left").drop(f"_k_{c}")
        df = df.withColumns({f"_enc_{c}_{tg}": F.coalesce(F.col(f"_enc_{c}_{tg}"), F.lit(m))
                             for tg, m in mu.items()})
    return df


TREE_BATCH = 50  # trees summed per step before the partial sum is materialised


def score_first_trees(model, df: DataFrame, k: int) -> DataFrame:
    """Prediction of the ensemble cut after its first ``k`` trees (the early-stopping
    choice), without refitting: a boosted regression predicts sum(weight_i * tree_i(x)).
    Each tree scores the rows with its own model; every ``TREE_BATCH`` trees the partial
    sum is checkpointed so the plan stays shallow. Only the rows to score pass here."""
    trees, weights = model.trees[:k], model.treeWeights[:k]
    out = df.withColumn("_pred", F.lit(0.0))
    for start in range(0, k, TREE_BATCH):
        cols = []
        for i in range(start, min(k, start + TREE_BATCH)):
            tree = trees[i].copy().setFeaturesCol("_features").setPredictionCol(f"_t{i}")
            out = tree.transform(out)
            cols.append(F.lit(float(weights[i])) * F.col(f"_t{i}"))
        total = cols[0]
        for c in cols[1:]:
            total = total + c
        out = out.withColumn("_pred", F.col("_pred") + total).drop(*[f"_t{i}" for i in range(start, start + len(cols))])
        if start + TREE_BATCH < k:
            out = cut_lineage(out)
    return out


def _assembler(cfg: ForecastConfig, nominal: list[str], encoded: list[str], target: str) -> VectorAssembler:
    """Numeric inputs, indexed low-cardinality categories (their nominal metadata makes
    the trees split them as categories) and target-encoded wide categories."""
    nums = [f for f in cfg.features if f not in CATEGORICAL]
    inputs = ([f"_x_{f}" for f in nums] + [f"_m_{f}" for f in nullable_inputs(nums, cfg)] + [f"_idx_{c}" for c in nominal]
              + [f"_enc_{c}_{target}" for c in encoded])
    return VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep")


def split_categoricals(cats: list[str], cardinality: dict[str, int], cfg: ForecastConfig) -> tuple[list[str], list[str]]:
    """The configured split of the categorical inputs: (tree categories, target means)."""
    nominal = [c for c in cats if c in cfg.nominal]
    wide = [c for c in nominal if cardinality.get(c, 0) + 1 > cfg.max_bins]
    if wide:
        raise ValueError(f"more values than max_bins={cfg.max_bins} in {wide}: raise it, or take them out of ``nominal``")
    return nominal, [c for c in cats if c not in nominal]


def nullable_inputs(nums: list[str], cfg: ForecastConfig) -> list[str]:
    """Numeric inputs that can be missing in an eligible row: lags and means but those that
    eligibility (D1) requires, and metadata percentages."""
    required = {"dispense_lag_7", f"dispense_roll_mean_{cfg.roll_long}", *cfg.required_columns}
    return [f for f in nums if (f.startswith("dispense_") or f.endswith("_pct")) and f not in required]


def _numeric_inputs(df: DataFrame, nums: list[str], cfg: ForecastConfig) -> DataFrame:
    values = {f"_x_{f}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in nums}
    return df.withColumns(values | {f"_m_{f}": F.col(f).isNull().cast("double") for f in nullable_inputs(nums, cfg)})


GROWTH = 50  # trees of the first stage; each further stage doubles them


def boosted_trees(cfg: ForecastConfig) -> GBTRegressor:
    """Spark's own boosting with the preset's parameters, as an ``estimator``: its first tree has weight 1."""
    return GBTRegressor(maxIter=cfg.max_iter, stepSize=cfg.step_size, maxDepth=cfg.max_depth, maxBins=cfg.max_bins,
                        minInstancesPerNode=cfg.min_instances_per_node, seed=cfg.seed, checkpointInterval=10)


def fit_stopped(estimator, train: DataFrame, val: DataFrame | None, patience: int):
    """(model, trees to use or None) of an ``estimator``: without validation rows the whole fit (M4), else
    boosted trees are refitted with twice as many until the patience rule stops."""
    if not isinstance(estimator, GBTRegressor) or val is None:
        model = estimator.fit(train)
        return model, model.getNumTrees if isinstance(estimator, GBTRegressor) else None
    most, n = estimator.getMaxIter(), GROWTH
    while True:
        n = min(n, most)
        model = estimator.copy({estimator.maxIter: n}).fit(train)
        errors = list(model.evaluateEachIteration(val, "squared"))
        k = best_iteration(errors, patience)
        if n == most or n - k >= patience:
            return model, k
        n *= 2


def _stable(df: DataFrame) -> DataFrame:
    """Materialise once in the shared folder: every later read (three fits, evaluation,
    scoring) sees the same partitions in the same row order, so tree building is
    repeatable, and a lost executor re-reads the checkpoint instead of the feature plan.
    No repartition: the data keeps the layout the feature plan produced (a hot machine
    stays split over its chunks instead of becoming one straggler partition)."""
    return cut_lineage(df)


def horizon_runs(split: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """M2, M4, M5 in one pass: for each horizon its train and validation rows, whether early stopping
    applies and whether it is skipped (no training rows). ``split`` has ``is_val``."""
    counts = split.agg(*[F.count_if(F.col(t).isNotNull() & (F.col("is_val") == v)).alias(f"{side}_{t}")
                         for _, t, _ in cfg.horizons for side, v in (("train", False), ("val", True))])
    rows = F.array(*[F.struct(F.lit(label).alias("horizon"), F.lit(t).alias("target"), F.col(f"train_{t}").alias("train_rows"),
                              F.col(f"val_{t}").alias("val_rows")) for label, t, _ in cfg.horizons])
    return counts.select(F.inline(rows)).withColumns({
        "early_stopping": F.col("val_rows") > cfg.early_stop_min_val_rows, "skipped": F.col("train_rows") == 0})


def train_and_forecast(cleaned: DataFrame, cfg: ForecastConfig = V1, estimator=None, model_path: str | None = None) -> tuple[DataFrame, ForecastRun]:
    """Train one model per horizon and score the latest row of every machine. ``model_path``: a shared
    folder that keeps the trees of every horizon (node tables); whole stages found there are used.

    Returns the wide frame (latest rows + one ``predicted_dispense_<label>`` column per
    trained horizon) and run diagnostics. Driver-side work is limited to a few scalars.
    """
    run = ForecastRun()
    data = ensure_not_empty(_stable(cleaned))
    max_date = data.agg(F.max("date")).first()[0]
    run.max_date = max_date
    run.split_date = max_date - dt.timedelta(days=cfg.val_days) if max_date else None
    is_val = F.col("date") > F.date_sub(F.lit(max_date), cfg.val_days)
    data = data.withColumns({"is_val": is_val, "_fold": encoding_fold(cfg.encoding_folds, is_val)})
    runs = [HorizonRun(r.horizon, r.target, r.train_rows, r.val_rows, r.early_stopping, skipped=r.skipped)
            for r in horizon_runs(data, cfg).collect()]  # a row for each horizon
    run.horizons = runs
    run.cleaned_rows = data.count()

    cats = [c for c in cfg.features if c in CATEGORICAL]
    nums = [f for f in cfg.features if f not in cats]
    trained = [h.target for h in runs if not h.skipped]
    latest = cut_lineage(panel.latest_per_atm(data.drop("is_val", "_fold")))
    if trained:
        train_side = data.where(~F.col("is_val"))
        tables, mu, cardinality = fit_target_encodings_by_fold(train_side, cats, trained, cfg.encoding_smoothing,
                                                               cfg.broadcast_max_rows)
        nominal, encoded = split_categoricals(cats, cardinality, cfg)
        tables = {c: t for c, t in tables.items() if c in encoded}

        def encode(df: DataFrame) -> DataFrame:
            return _numeric_inputs(apply_encodings_by_fold(df, tables, mu), nums, cfg)

        # The joins run once: every horizon reads these rows several times, and the machines' table may be too large for a broadcast.
        inputs = [*nominal, *[f"_x_{f}" for f in nums], *[f"_m_{f}" for f in nullable_inputs(nums, cfg)], *[f"_enc_{c}_{t}" for c in encoded for t in trained]]
        data_x = cut_lineage(encode(data).select(*inputs, *trained, "is_val"))
        latest_x = cut_lineage(encode(latest.withColumn("_fold", F.lit(NO_FOLD))).select("atm_id", *inputs))
        if nominal:
            # the label lists are bounded by max_bins (checked by split_categoricals)
            indexer = StringIndexer(inputCols=nominal, outputCols=[f"_idx_{c}" for c in nominal],
                                    handleInvalid="keep", stringOrderType="alphabetAsc").fit(train_side)
            data_x, latest_x = indexer.transform(data_x), indexer.transform(latest_x)
    def fit_and_score(h: HorizonRun) -> DataFrame:
        """M1, M3, M4, M6-M8 for one horizon; returns (atm_id, prediction)."""
        target = h.target
        assembler = _assembler(cfg, nominal, encoded, target)
        rows = assembler.transform(data_x.where(F.col(target).isNotNull())).select(
            "_features", F.col(target).cast("double").alias("_label"), "is_val")
        latest_v = assembler.transform(latest_x)
        # all rounds are wanted where nothing can stop them: one fit of Spark's own booster costs far fewer jobs a tree
        pred = _boosted(h, rows, latest_v) if estimator is None and h.early_stopping else _estimated(h, rows, latest_v)
        return cut_lineage(pred.select(F.col("atm_id").alias("_p_atm"), postprocess_prediction(F.col("_pred"), cfg.clip_lower)
                                       .alias(f"predicted_dispense_{h.label}")))

    def _boosted(h: HorizonRun, rows: DataFrame, latest_v: DataFrame) -> DataFrame:
        path = f"{model_path.rstrip('/')}/{h.label}" if model_path else None
        model = boosting.boost(rows, cfg.max_iter, cfg.step_size, cfg.patience if h.early_stopping else None, cfg.max_depth, cfg.max_bins,
                               cfg.min_instances_per_node, cfg.seed, cfg.stage_trees, path)
        h.trees, h.grown = model.keep, model.trees
        if model.keep and model.val_errors[model.keep - 1] is not None:
            h.val_rmse = model.val_errors[model.keep - 1] ** 0.5
            h.mean_rmse = rows.where("is_val").agg(F.avg((F.col("_label") - F.lit(model.base)) ** 2)).first()[0] ** 0.5
        trees = model.nodes(latest_v.sparkSession)
        return latest_v.withColumn("_pred", boosting.score(trees, boosting.feature_array(), model.base))

    def _estimated(h: HorizonRun, rows: DataFrame, latest_v: DataFrame) -> DataFrame:
        train = rows.where(~F.col("is_val")).select("_features", "_label").coalesce(boosting.training_tasks(h.train_rows)).persist()
        regressor = (estimator or boosted_trees(cfg)).copy().setFeaturesCol("_features").setLabelCol("_label").setPredictionCol("_pred")
        h.early_stopping = h.early_stopping and isinstance(regressor, GBTRegressor)
        model, k = fit_stopped(regressor, train, rows.where("is_val") if h.early_stopping else None, cfg.patience)
        h.trees = h.grown = k or 0
        train.unpersist()
        return score_first_trees(model, latest_v, k) if k is not None and k < model.getNumTrees else model.transform(latest_v)

    for h in runs:
        if h.skipped and not cfg.skip_empty_horizon:
            raise ValueError(f"no training rows for {h.target}")
    todo = [h for h in runs if not h.skipped]  # M5: a skipped horizon disappears from the output
    # The horizons are independent fits on the same materialised data: submit them from
    # driver threads so their (small, many) jobs share the cluster instead of queueing.
    workers = max(1, min(len(todo), cfg.parallel_horizons))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        scored_all = list(pool.map(fit_and_score, todo))
    wide = latest
    for scored in scored_all:
        wide = wide.join(scored, wide["atm_id"].eqNullSafe(scored["_p_atm"]), "left").drop("_p_atm")
    return wide, run
