"""Trees grown from coded rows are Spark's trees, and a tournament keeps no rows in Spark's cache."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators import evaluate, models, prepare, trees
from riskspark.plans import training
from riskspark.sources import runs
from riskspark.spec import JobSpec

SPEC = JobSpec(features=("a", "b", "c"), target="y", grids={})


def with_grid(name, **grid):
    return replace(SPEC, grids={name: {k: v if isinstance(v, tuple) else (v,) for k, v in grid.items()}})


@pytest.fixture(scope="module")
def rows(spark):
    """Few values in a, many in b, nearly only zeros in c."""
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(-4, 5, 3000), rng.normal(size=3000), np.where(rng.random(3000) < 0.9, 0.0, 2.0)
    y = np.sin(a) + 0.3 * b * b + c * (a > 0) + 0.1 * rng.normal(size=3000)
    data = [(float(a[i]), float(b[i]), float(c[i]), float(y[i]), i % 3, "test" if i % 5 == 0 else "train")
            for i in range(3000)]
    return spark.createDataFrame(data, "a double, b double, c double, y double, fold int, split string").repartition(5).persist()


@pytest.fixture(scope="module")
def train(rows):
    return prepare.assemble(rows, SPEC.features).select("features", "y", "fold").persist()


SURE = [("DecisionTreeRegressor", {"maxDepth": 6, "minInstancesPerNode": 7}),
        ("DecisionTreeRegressor", {"maxDepth": 4, "maxBins": 9, "minInfoGain": 0.01}),
        ("DecisionTreeRegressor", {"maxDepth": 0}),
        ("RandomForestRegressor", {"maxDepth": 3, "numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"}),
        ("GradientBoostingRegressor", {"maxDepth": 3, "maxIter": 7, "stepSize": 0.3}),
        ("GradientBoostingRegressor", {"maxDepth": 2, "maxIter": 3, "lossType": "absolute"})]


def rmse(model, rows):
    return model.transform(rows).agg(evaluate.metric("rmse", "y", "prediction")).first()[0]


@pytest.mark.parametrize("name, params", SURE)
def test_trees_are_those_of_spark(train, name, params):
    spec = with_grid(name, **params)
    coded = models.tree_rows(train, spec, whole=True)
    try:
        ours, found = models.fit_trees(coded, name, spec, params), models.grid_search(train, name, spec, coded=coded)
    finally:
        coded.drop()
    theirs = models.make_estimator(name, spec, params).fit(train)
    both = ours.transform(theirs.setPredictionCol("p").transform(train))
    assert both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    if hasattr(theirs, "numNodes"):
        assert (ours.numNodes, ours.depth) == (theirs.numNodes, theirs.depth)
    folds = [rmse(models.make_estimator(name, spec, params).fit(train.where(F.col("fold") != k)),
                  train.where(F.col("fold") == k)) for k in range(3)]
    assert abs(found.avg_rmse[0] - np.mean(folds)) < 1e-9


def test_a_boosted_model_writes_its_sums_down(train, monkeypatch):
    """The scans of a long model walk few trees: the sums of the others stand in the blocks."""
    spec, params = with_grid("GradientBoostingRegressor", maxDepth=2, maxIter=9), {"maxDepth": 2, "maxIter": 9}
    calls, plain = [], trees._based
    monkeypatch.setattr(trees, "_based", lambda *a: (calls.append(a[2]), plain(*a))[1])
    coded = models.tree_rows(train, spec, whole=True)
    try:
        ours = models.fit_trees(coded, "GradientBoostingRegressor", spec, params)
    finally:
        coded.drop()
    assert calls == [{0: 4}, {0: 8}]
    theirs = models.make_estimator("GradientBoostingRegressor", spec, params).fit(train)
    assert abs(rmse(ours, train) - rmse(theirs, train)) < 1e-12


def test_points_that_differ_in_depth_or_number_are_one_fit(train, monkeypatch):
    grown, grow = [], trees.grow
    monkeypatch.setattr(trees, "grow", lambda rows, fits: (grown.append(len(fits)), grow(rows, fits)))
    name = "DecisionTreeRegressor"
    spec = with_grid(name, maxDepth=(2, 5), minInstancesPerNode=(1, 40))
    many = models.grid_search(train, name, spec).avg_rmse
    assert grown == [6]
    for point, score in zip(spec.grid_points(name), many, strict=True):
        assert abs(models.grid_search(train, name, with_grid(name, **point)).avg_rmse[0] - score) < 1e-12
    name = "GradientBoostingRegressor"
    few, more = models.grid_search(train, name, with_grid(name, maxDepth=2, maxIter=(2, 5))).avg_rmse
    assert grown[-1] == 3
    assert abs(models.grid_search(train, name, with_grid(name, maxDepth=2, maxIter=2)).avg_rmse[0] - few) < 1e-12
    assert abs(models.grid_search(train, name, with_grid(name, maxDepth=2, maxIter=5)).avg_rmse[0] - more) < 1e-12


def test_bags_repeat_and_have_the_right_mean(train):
    name, params = "RandomForestRegressor", {"maxDepth": 4, "numTrees": 12, "subsamplingRate": 0.7}
    spec = with_grid(name, **params)
    coded = models.tree_rows(train, spec, whole=True)
    try:
        one, two = (models.fit_trees(coded, name, spec, params) for _ in range(2))
    finally:
        coded.drop()
    assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]
    assert len({t.toDebugString.split("\n", 1)[1] for t in one.trees}) == 12
    assert abs(rmse(one, train) / rmse(models.make_estimator(name, spec, params).fit(train), train) - 1) < 0.1
    fit = models._fit_of(models.make_estimator(name, spec, params), None, 1)
    bag = fit.bag(3, 5 << 40, 200_000)
    assert np.array_equal(bag[1000:1500], fit.bag(3, (5 << 40) + 1000, 500))
    assert abs(bag.mean() - 0.7) < 0.01 and abs(bag.var() - 0.7) < 0.02
    assert abs(np.corrcoef(bag, fit.bag(4, 5 << 40, 200_000))[0, 1]) < 0.01


def test_subsets_are_counted_as_in_spark():
    counts = {s: trees.subset_size(s, 17, 5) for s in ("all", "auto", "sqrt", "log2", "onethird", "4", "40", "0.5", "1.0")}
    assert counts == {"all": 17, "auto": 6, "sqrt": 5, "log2": 5, "onethird": 6, "4": 4, "40": 17, "0.5": 9, "1.0": 17}
    assert trees.subset_size("auto", 17, 1) == 17


def test_rows_that_only_spark_can_judge_go_the_plain_way(spark, rows, train):
    name = "DecisionTreeRegressor"
    spec = with_grid(name, maxDepth=2)
    missing = train.withColumn("y", F.when(F.col("y") < 1.5, F.col("y")))
    assert models.tree_rows(missing, spec) is None
    with pytest.raises(Exception, match="(?i)label|null"):
        models.grid_search(missing, name, spec)
    assert models.tree_rows(train.where("fold = 1"), spec) is None
    assert models.tree_rows(train.limit(0), spec) is None
    marked = train.withColumn("features", F.col("features").alias(
        "features", metadata={"ml_attr": {"attrs": {"nominal": [{"idx": 0, "vals": ["x"]}]}}}))
    assert models.tree_rows(marked, spec) is None


def test_a_large_fold_does_not_bring_all_rows_into_the_sample(spark, monkeypatch):
    """Nearly all rows in one fold: the fit without it takes its sample from the few others."""
    wide = spark.range(200_000).select((F.col("id") % 7).cast("double").alias("a"), F.rand(1).alias("b"),
                                       F.rand(2).alias("c"), F.rand(3).alias("y"),
                                       F.when(F.col("id") < 60, F.col("id") % 2).otherwise(2).alias("fold"))
    seen, plain = [], trees.thresholds
    monkeypatch.setattr(trees, "thresholds", lambda v, *a: (seen.append(len(v)), plain(v, *a))[1])
    coded = models.tree_rows(prepare.assemble(wide, SPEC.features), with_grid("DecisionTreeRegressor", maxDepth=2))
    coded.drop()
    assert max(seen) < 11_000 and min(seen) == 60 and coded.sizes == {0: 30, 1: 30, 2: 199_940}


GRIDS = {"LinearRegression": {"regParam": (0.01, 0.1)}, "DecisionTreeRegressor": {"maxDepth": (2, 3)},
         "RandomForestRegressor": {"numTrees": (3,), "maxDepth": (3,)},
         "GradientBoostingRegressor": {"maxDepth": (2,), "maxIter": (3,)}}


@pytest.mark.parametrize("scaled", [True, False])
def test_a_tournament_keeps_no_rows_in_the_cache(spark, rows, tmp_path, monkeypatch, scaled):
    """Spark's cache and its tree estimators hold the rows of a partition as objects, several times."""
    def refused(*_):
        raise AssertionError("rows were cached or handed to an estimator that caches them")

    source = rows.select(*SPEC.kept, "split", "fold")
    with monkeypatch.context() as patched:
        patched.setattr(DataFrame, "persist", refused)
        for kind in (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor):
            patched.setattr(kind, "fit", refused)
        result = training.tournament(source, replace(SPEC, grids=GRIDS), scaled=scaled)
    assert isinstance(result.models["LinearRegression"], LinearRegressionModel)
    scores = {r["model"]: r for r in result.scores.collect()}
    assert list(result.models) == list(GRIDS) and scores.keys() == GRIDS.keys()
    assert all(0 < r["Test_R2"] < 1 for r in scores.values())
    if scaled:  # a saved model is the model
        vectors = prepare.assemble(source.where("split = 'test'"), SPEC.features)
        for name, model in result.models.items():
            assert abs(rmse(model, vectors) - scores[name]["Test_RMSE"]) < 1e-9
            runs.save_model(PipelineModel(stages=[model]), f"{tmp_path}/{name}")
            again = PipelineModel.load(f"{tmp_path}/{name}")
            assert abs(rmse(again, vectors) - scores[name]["Test_RMSE"]) < 1e-9
            if name != "LinearRegression":
                assert again.stages[0].getMaxDepth() == result.models[name].getMaxDepth() == (
                    result.searches[name].points[result.searches[name].best]["maxDepth"])


@pytest.mark.parametrize("part", ["train", "test"])
def test_a_missing_feature_of_either_split_is_an_error(rows, part):
    spec = replace(SPEC, grids={"DecisionTreeRegressor": {"maxDepth": (2,)}})
    holes = rows.withColumn("b", F.when((F.col("split") != part) | (F.col("b") < 1.0), F.col("b")))
    with pytest.raises(Exception, match="(?i)null"):
        training.tournament(holes.select(*SPEC.kept, "split", "fold"), spec)


def test_a_tournament_leaves_no_work_tables(spark, rows):
    from riskspark.session import shared_dir

    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/work")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    spec = replace(SPEC, grids={"DecisionTreeRegressor": {"maxDepth": (2,)}})

    def tables():
        return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()

    before = tables()
    training.tournament(rows.select(*SPEC.kept, "split", "fold"), spec)
    with pytest.raises(ValueError, match="no training rows"):
        training.tournament(rows.where("split = 'test'").select(*SPEC.kept, "split", "fold"), spec)
    assert tables() == before
