"""Estimators, parameter grids, cross-validated search, model inspection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.operators import trees as T
from riskspark.operators.evaluate import metric
from riskspark.operators.prepare import assemble
from riskspark.operators.scaling import Scaler, apply_scaler, scaler_stages
from riskspark.spec import PRESETS, JobSpec

ESTIMATORS = {
    "LinearRegression": LinearRegression,
    "DecisionTreeRegressor": DecisionTreeRegressor,
    "RandomForestRegressor": RandomForestRegressor,
    "GradientBoostingRegressor": GBTRegressor,
}


def make_estimator(name: str, spec: JobSpec, params: dict | None = None,
                   features: str = "features"):
    """A regressor with its seed set, so that equal input gives an equal model."""
    estimator = ESTIMATORS[name](featuresCol=features, labelCol=spec.target)
    if name != "LinearRegression":
        # More histogram memory means fewer passes over the rows per tree level.
        estimator.setParams(seed=spec.seed, maxMemoryInMB=1024)
    return estimator.setParams(**(params or {}))


def make_preset(preset: str, spec: JobSpec, features: str = "features"):
    name, params = PRESETS[preset]
    return make_estimator(name, spec, params, features)


def grid_table(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Every grid point as a row ``(model, ordinal, grid_id, params)``."""
    rows = [(model, ordinal, i, {k: float(v) for k, v in point.items()})
            for ordinal, model in enumerate(spec.grids)
            for i, point in enumerate(spec.grid_points(model))]
    return spark.createDataFrame(
        rows, "model string, ordinal int, grid_id int, params map<string,double>")


def regression_stages(spec: JobSpec, name: str, params: dict | None = None,
                      scaled: bool = True) -> list:
    """Stages from raw columns to prediction; the scaler travels with the regressor."""
    assembler, scaler = scaler_stages(spec.features)
    regressor = make_estimator(name, spec, params)
    if scaled:
        return [assembler, scaler, regressor]
    return [assembler.setOutputCol("features"), regressor]


def fit_model(train: DataFrame, spec: JobSpec, name: str = "LinearRegression",
              params: dict | None = None, scaled: bool = True,
              partitions: int | None = None) -> PipelineModel:
    """Fit scaler and regressor. Both read the rows more than once, so the needed columns
    are kept (spilling to disk) while fitting. ``partitions`` deals the rows out first, for
    sources that come in fewer parts than there are cores."""
    rows = train.select(*spec.kept)
    rows = (rows.repartition(partitions) if partitions else rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=regression_stages(spec, name, params, scaled)).fit(rows)
    finally:
        rows.unpersist()


# ---- cross-validated grid search ------------------------------------------------------------

@dataclass(frozen=True)
class SearchResult:
    model: str
    points: list[dict]
    avg_rmse: list[float]

    @property
    def best(self) -> int:
        """Index of the lowest mean RMSE, the first one on ties."""
        usable = [(v, i) for i, v in enumerate(self.avg_rmse) if v == v]
        if not usable:
            raise ValueError(f"no usable cross-validation score for {self.model}")
        return min(usable)[1]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(self.model, i, {k: float(v) for k, v in p.items()}, r)
                for i, (p, r) in enumerate(zip(self.points, self.avg_rmse))]
        return spark.createDataFrame(
            rows, "model string, grid_id int, params map<string,double>, avg_rmse double")


def grid_search(train: DataFrame, name: str, spec: JobSpec, fold: str = "fold",
                parallelism: int = 4, scalers: dict[int, Scaler] | None = None,
                coded: T.CodedRows | None = None, values: Column | None = None) -> SearchResult:
    """k-fold search over a model's grid on rows with ``features``, target and ``fold``.

    With ``scalers`` (see ``fold_scalers``) the rows hold raw feature columns instead, and each
    fold's fits and scores see them standardised by the other folds' rows only.

    Fits run as concurrent Spark jobs. All grid points of a fold are scored together, so
    a fold is scanned once for its scores and not once per point. Least squares see the rows by
    their moments only: one scan reads those of every fold, each fit is given a few weighted rows
    that have the moments of its folds, and one more scan scores all of them. Trees are grown from
    ``coded`` rows (see ``tree_rows``, made here if not given), those of all fits in the same scans.
    ``values`` is an array of what ``features`` holds, where that is at hand without the vector.
    """
    spark = train.sparkSession
    points = spec.grid_points(name)
    if name != "LinearRegression":
        found = _tree_search(train, name, spec, fold, scalers, coded)
        if found is not None:
            return found
    if scalers is not None:
        values = F.array(*[F.col(f).cast("double") for f in spec.features])
    elif values is None:
        values = vector_to_array("features")
    by_moments = all(_least_squares(make_estimator(name, spec, p)) for p in points)
    moments = fold_moments(train, values, spec.target, fold) if by_moments else {}

    def prepared(rows, k):
        return rows if scalers is None else assemble(apply_scaler(rows, scalers[k]), spec.features)

    def alike(k):
        """Few rows to fit in place of the other folds' rows, if moments can be had."""
        merged = merged_moments([m for other, m in moments.items() if other != k])
        if merged is None or len(merged[1]) - 1 > NORMAL_FEATURES:
            return None
        points, weight = rows_of_moments(*merged)
        rows = spark.createDataFrame([(p[:-1].tolist(), float(p[-1]), weight) for p in points],
                                     f"_x array<double>, `{spec.target}` double, _weight double")
        features = ({"features": array_to_vector("_x")} if scalers is None
                    else {f: F.col("_x")[i] for i, f in enumerate(spec.features)})
        return prepared(rows.withColumns(features).drop("_x"), k).coalesce(1)

    def fit(task):
        k, i = task
        estimator, rows = make_estimator(name, spec, points[i]), few[k]
        if rows is None:
            rows = prepared(train.where(F.col(fold) != k), k)
        else:
            estimator.setWeightCol("_weight")
        return estimator.fit(rows).setPredictionCol(f"p{i}")

    def score(k):
        scored = prepared(train.where(F.col(fold) == k), k)
        for model in models[k]:
            scored = model.transform(scored)
        row = scored.agg(*[metric("rmse", spec.target, f"p{i}").alias(f"p{i}")
                           for i in range(len(points))]).first()
        return [float("nan") if row[f"p{i}"] is None else row[f"p{i}"]
                for i in range(len(points))]

    few = {k: alike(k) for k in range(spec.folds)}
    tasks = [(k, i) for k in range(spec.folds) for i in range(len(points))]
    pool = ThreadPool(min(parallelism, len(tasks)))
    try:
        fitted = pool.map(inheritable_thread_target(spark)(fit), tasks)
        models = [[m for (k, _), m in zip(tasks, fitted) if k == fold_no]
                  for fold_no in range(spec.folds)]
        if all(rows is not None for rows in few.values()):
            scores = _linear_scores(train, values, spec.target, fold, models, scalers)
        else:
            scores = pool.map(inheritable_thread_target(spark)(score), range(spec.folds))
    finally:
        pool.close()
    return SearchResult(name, points, [float(np.mean(c)) for c in zip(*scores)])


# ---- trees by histograms ----------------------------------------------------------------------

def _growable(estimator) -> bool:
    """Whether a fit is one that ``trees`` grows: plain rows and no held-back ones."""
    return not (estimator.isSet("weightCol") or estimator.hasParam("validationIndicatorCol")
                and estimator.isSet("validationIndicatorCol"))


def _numeric(train: DataFrame, features: str = "features") -> bool:
    """Whether no element of the vector is marked as a category."""
    marks = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return not marks.get("nominal") and not marks.get("binary")


def _fit_of(estimator, fold: int | None, rows: int) -> T.Fit:
    """An estimator's settings; those that Spark refuses are refused."""
    estimator._transfer_params_to_java()
    boosted, forest = isinstance(estimator, GBTRegressor), isinstance(estimator, RandomForestRegressor)
    many = boosted or forest
    return T.Fit(fold, boosted, estimator.getMaxDepth(),
                 estimator.getMaxIter() if boosted else estimator.getNumTrees() if forest else 1,
                 estimator.getMaxBins(), estimator.getMinInstancesPerNode(),
                 estimator.getMinWeightFractionPerNode() * rows, estimator.getMinInfoGain(),
                 estimator.getSubsamplingRate() if many else 1.0, forest and estimator.getBootstrap(),
                 estimator.getFeatureSubsetStrategy() if many else "all",
                 estimator.getStepSize() if boosted else 1.0,
                 estimator.getLossType() if boosted else "squared", estimator.getSeed())


def tree_rows(train: DataFrame, spec: JobSpec, names: Sequence[str] | None = None, fold: str = "fold",
              whole: bool = False, values: Column | None = None) -> T.CodedRows | None:
    """The rows coded for the tree searches of a job, and with ``whole`` for fits on all rows.

    None if there are none or Spark's own estimators have to read the rows: with weights,
    categories, missing values or folds without others. Call ``drop`` on the result.
    """
    names = [n for n in names or spec.grids if n != "LinearRegression"]
    estimators = [make_estimator(n, spec, p) for n in names for p in spec.grid_points(n)]
    if (not estimators or not all(map(_growable, estimators))
            or "features" in train.columns and not _numeric(train)):
        return None
    return T.code_rows(train, vector_to_array("features") if values is None else values, spec.target,
                       [*range(spec.folds), *[None] * whole], [e.getMaxBins() for e in estimators],
                       spec.seed, fold)


def _tree_search(train: DataFrame, name: str, spec: JobSpec, fold: str,
                 scalers: dict[int, Scaler] | None, coded: T.CodedRows | None) -> SearchResult | None:
    """The search over trees, or None if Spark's own estimators have to read the rows.

    Scaling moves the thresholds along with the values, so ``scalers`` do not matter. Points that
    differ in depth (but for boosted models) or number of trees alone are parts of one fit.
    """
    points, own = spec.grid_points(name), None
    if coded is None:
        raw = None if scalers is None else F.array(*[F.col(f).cast("double") for f in spec.features])
        coded = own = tree_rows(train, spec, [name], fold, values=raw)
    if coded is None:
        return None
    try:
        grown: dict[tuple, T.Fit] = {}
        wanted = []
        for k in range(spec.folds):
            for point in points:
                fit = _fit_of(make_estimator(name, spec, point), k, coded.seen(k))
                subset = T.subset_size(fit.subset, len(coded.marks), 1 if fit.boosted else fit.count)
                alike = (k, subset, fit.boosted and fit.depth, fit.max_bins, fit.min_instances, fit.min_weight,
                         fit.min_gain, fit.rate, fit.bootstrap, fit.step, fit.loss, fit.seed)
                wanted.append((alike, fit.depth, fit.count))
                largest = grown.setdefault(alike, fit)
                largest.depth, largest.count = max(largest.depth, fit.depth), max(largest.count, fit.count)
        T.grow(coded, list(grown.values()))
        rmse = T.fold_errors(coded, [(grown[alike], depth, count) for alike, depth, count in wanted])
    finally:
        if own is not None:
            own.drop()
    return SearchResult(name, points, [float(np.mean(rmse[i::len(points)])) for i in range(len(points))])


def fit_trees(coded: T.CodedRows, name: str, spec: JobSpec, params: dict):
    """Spark's model of one grid point, grown on all coded rows."""
    estimator = make_estimator(name, spec, params)
    fit = _fit_of(estimator, None, coded.seen(None))
    T.grow(coded, [fit])
    return T.spark_model(coded, fit, estimator)


# ---- least squares by moments ---------------------------------------------------------------

#: Up to so many features Spark solves least squares by the normal equations.
NORMAL_FEATURES = 4096
MOMENTS = "_fold long, n long, means array<double>, squares array<double>"


def _least_squares(estimator) -> bool:
    """Whether a fit depends on the rows' moments alone."""
    return (isinstance(estimator, LinearRegression) and estimator.getLoss() == "squaredError"
            and estimator.getSolver() != "l-bfgs" and not estimator.isSet("weightCol"))


def _folded(train: DataFrame, values: Column, target: str, fold: str) -> DataFrame:
    return (train.where(F.col(fold).isNotNull())
            .select(F.col(fold).cast("long"), values, F.col(target).cast("double")))


def _by_fold(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A batch of ``_folded`` as arrays: each fold's values, a row a line, and targets."""
    if not batch.num_rows:
        return
    folds = batch.column(0).to_numpy(zero_copy_only=False)
    y = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
    x = batch.column(1)
    flat = (np.full(len(y), np.nan) if x.null_count
            else x.flatten().to_numpy(zero_copy_only=False).astype(float)).reshape(len(y), -1)
    for k in np.unique(folds).tolist():
        yield k, flat[folds == k], y[folds == k]


def _linear_scores(train: DataFrame, values: Column, target: str, fold: str, models: list[list],
                   scalers: dict[int, Scaler] | None) -> list[list[float]]:
    """RMSE of each fold's models on its rows, from one scan; NaN for a fold without rows."""
    known = {}
    for k, fitted in enumerate(models):
        weights = np.array([m.coefficients.toArray() for m in fitted]).T
        means, stds = (np.zeros(len(weights)), np.ones(len(weights))) if scalers is None else (
            np.array(scalers[k].means), np.array(scalers[k].stds))
        known[k] = (means, np.where(stds == 0, 1.0, stds), np.where(stds[:, None] == 0, 0.0, weights),
                    np.array([m.intercept for m in fitted]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for k, x, y in _by_fold(batch):
                if k in known:
                    means, stds, weights, intercepts = known[k]
                    errors = y[:, None] - ((x - means) / stds @ weights + intercepts)
                    n, squares = found.get(k, (0, 0.0))
                    found[k] = n + len(y), squares + (errors * errors).sum(0)
        for k, (n, squares) in found.items():
            yield pa.RecordBatch.from_pydict({"_fold": [k], "n": [n], "squares": [squares.tolist()]})

    rows = (_folded(train, values, target, fold)
            .mapInArrow(run, "_fold long, n long, squares array<double>").collect())  # one a task and fold
    scores = []
    for k, fitted in enumerate(models):
        mine = [r for r in rows if r["_fold"] == k]
        n = sum(r["n"] for r in mine)
        scores.append(np.sqrt(np.sum([r["squares"] for r in mine], 0) / n).tolist() if n
                      else [float("nan")] * len(fitted))
    return scores


def fold_moments(train: DataFrame, values: Column, target: str, fold: str = "fold") -> dict[int, tuple]:
    """For each fold ``(n, means, squares)`` of an array of values and the target, from one scan.

    ``squares`` holds the sums of products of deviations from the means. Each task gives one row a
    fold. A null makes the figures of its fold NaN; a row without a fold takes no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for k, x, y in _by_fold(batch):
                mine = np.column_stack([x, y])
                means = mine.mean(0)
                apart = mine - means
                part = (len(mine), means, apart.T @ apart)
                found[k] = merge_moments(found[k], part) if k in found else part
        for k, (n, means, squares) in found.items():
            yield pa.RecordBatch.from_pydict({"_fold": [k], "n": [n], "means": [means.tolist()],
                                              "squares": [squares.ravel().tolist()]})

    rows = _folded(train, values, target, fold).mapInArrow(run, MOMENTS).collect()  # one a task and fold
    parts: dict[int, list] = {}
    for r in rows:
        means = np.array(r["means"])
        parts.setdefault(r["_fold"], []).append(
            (r["n"], means, np.array(r["squares"]).reshape(len(means), -1)))
    return {k: merged_moments(p, any_value=True) for k, p in parts.items()}


def merge_moments(a: tuple, b: tuple) -> tuple:
    """The moments of two sets of rows together."""
    if len(a[1]) != len(b[1]):
        return a[0] + b[0], a[1] * np.nan, a[2] * np.nan
    n, apart = a[0] + b[0], b[1] - a[1]
    return (n, a[1] + apart * (b[0] / n),
            a[2] + b[2] + np.outer(apart, apart) * (a[0] * (b[0] / n)))


def merged_moments(parts: Sequence[tuple], any_value: bool = False) -> tuple | None:
    """The moments of several sets of rows together; None without rows or if they are not finite."""
    if not parts:
        return None
    total = parts[0]
    for part in parts[1:]:
        total = merge_moments(total, part)
    usable = any_value or (np.isfinite(total[1]).all() and np.isfinite(total[2]).all())
    return total if usable else None


def rows_of_moments(n: int, means: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, float]:
    """Rows that have the given moments if each counts with the returned weight.

    They lie in pairs around the means, along the axes of the correlations.
    """
    spread = np.sqrt(np.diag(squares) / n)
    unit = np.where(spread > 0, spread, 1.0)
    size, axes = np.linalg.eigh(squares / n / np.outer(unit, unit))
    steps = (axes * np.sqrt(np.maximum(size, 0) * len(means))).T * unit
    return np.concatenate([means + steps, means - steps]), n / (2 * len(means))


# ---- inspection -----------------------------------------------------------------------------

@dataclass(frozen=True)
class LinearWeights:
    """Weights over raw feature columns."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float


def predictive_stage(model: PipelineModel):
    """``("linear" | "tree", stage)`` of the first stage that predicts."""
    for stage in model.stages:
        if hasattr(stage, "coefficients") and hasattr(stage, "intercept"):
            return "linear", stage
        if hasattr(stage, "featureImportances"):
            return "tree", stage
    raise ValueError("the model has neither a linear nor a tree stage")


def linear_weights(model: PipelineModel, features: Sequence[str],
                   scaled: bool = True) -> LinearWeights:
    """Weights of the linear stage for raw columns.

    The scaler in front of it is folded into the weights: w / std, b - sum(w * mean / std).
    ``scaled=False`` leaves the scaler out, as if raw values were already standardised.
    """
    kind, stage = predictive_stage(model)
    if kind != "linear":
        raise ValueError("the model has no linear stage")
    weights = stage.coefficients.toArray()
    intercept = float(stage.intercept)
    scaler = next((s for s in model.stages if hasattr(s, "mean") and hasattr(s, "std")), None)
    if scaled and scaler is not None:
        mean, std = scaler.mean.toArray(), scaler.std.toArray()
        weights = np.divide(weights, std, out=np.zeros_like(weights), where=std != 0)
        intercept -= float(weights @ mean)
    return LinearWeights(tuple(features), tuple(float(w) for w in weights), intercept)


def weights_table(spark: SparkSession, weights: LinearWeights) -> DataFrame:
    """Rows ``(pos, term, weight)``; the intercept has position -1."""
    rows = [(-1, "intercept", weights.intercept),
            *[(i, f, c) for i, (f, c) in enumerate(zip(weights.features, weights.coefficients))]]
    return spark.createDataFrame(rows, "pos int, term string, weight double")


def importance_table(spark: SparkSession, model: PipelineModel,
                     features: Sequence[str]) -> DataFrame:
    """Rows ``(pos, feature, importance)`` of a tree model."""
    kind, stage = predictive_stage(model)
    if kind != "tree":
        raise ValueError("the model has no tree stage")
    rows = [(i, f, float(v)) for i, (f, v) in
            enumerate(zip(features, stage.featureImportances.toArray()))]
    return spark.createDataFrame(rows, "pos int, feature string, importance double")


NODES = ("tree int, node long, feature string, threshold double, prediction double, "
         "impurity double, gain double, rows double, below long, above long, weight double")


def node_table(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Every node of a tree, forest or boosted model as a row.

    Nodes are numbered 1, 2 n and 2 n + 1. An inner node has a feature and a threshold: rows up
    to the threshold go ``below``, others ``above``. ``rows`` counts the (weighted) training rows
    of the node, ``weight`` is the tree's share in the prediction.
    """
    kind, stage = predictive_stage(model)
    if kind != "tree":
        raise ValueError("the model has no tree stage")
    trees = list(getattr(stage, "trees", [stage]))
    weights = [float(w) for w in getattr(stage, "treeWeights", [1.0])]
    if type(stage).__name__.startswith("RandomForest"):
        weights = [w / sum(weights) for w in weights]
    rows = []
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        waiting = [(1, tree._java_obj.rootNode())]
        while waiting:  # a tree of bounded depth
            number, node = waiting.pop()
            inner = node.subtreeDepth() > 0
            feature = threshold = gain = below = above = None
            if inner:
                split = node.split()
                if "Continuous" not in split.getClass().getName():
                    raise ValueError("a split of a categorical feature has no threshold")
                feature, threshold = features[split.featureIndex()], float(split.threshold())
                gain, below, above = float(node.gain()), 2 * number, 2 * number + 1
                waiting += [(below, node.leftChild()), (above, node.rightChild())]
            rows.append((i, number, feature, threshold, float(node.prediction()), float(node.impurity()),
                         gain, float(node.impurityStats().count()), below, above, weight))
    return spark.createDataFrame(rows, NODES)


def tree_score(nodes: Sequence) -> Column:
    """The prediction of a node table's rows as one expression over the raw feature columns.

    It stays inside generated code: no vector is assembled and no model is shipped.
    """
    trees: dict[int, dict] = {}
    for row in nodes:
        trees.setdefault(row["tree"], {})[row["node"]] = row

    def under(tree: dict, number: int) -> Column:
        row = tree[number]
        if row["feature"] is None:
            return F.lit(row["prediction"])
        return (F.when(F.col(row["feature"]) <= row["threshold"], under(tree, row["below"]))
                .otherwise(under(tree, row["above"])))

    total = F.lit(0.0)
    for tree in trees.values():
        total = total + F.lit(tree[1]["weight"]) * under(tree, 1)
    return total


def gain_importances(nodes: DataFrame, features: Sequence[str], per_tree: bool = True) -> DataFrame:
    """Rows ``(pos, feature, importance)`` from the gains in a node table.

    A split counts by its gain times its rows. Each tree's sums are brought to 1 first
    (``per_tree``, as for forests; boosted models add up as they are), then the whole to 1.
    """
    split = nodes.where("feature is not null").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("rows")).alias("gained"))
    if per_tree:
        split = split.withColumn("gained", F.col("gained") / F.sum("gained").over(Window.partitionBy("tree")))
    summed = split.groupBy("feature").agg(F.sum("gained").alias("gained"))
    every = nodes.sparkSession.createDataFrame(list(enumerate(features)), "pos int, feature string")
    share = F.coalesce("gained", F.lit(0.0))
    return (every.join(F.broadcast(summed), "feature", "left")
            .select("pos", "feature", (share / F.sum(share).over(Window.partitionBy())).alias("importance")))


def best_params_table(spark: SparkSession, result: SearchResult) -> DataFrame:
    """Chosen hyper-parameters as rows ``(model, name, value)``."""
    rows = [(result.model, k, float(v)) for k, v in result.points[result.best].items()]
    return spark.createDataFrame(rows, "model string, name string, value double")
