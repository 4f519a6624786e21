"""Split, scaling, models and whole jobs."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.tables import FX, fx, rx
from riskspark.operators import evaluate, models, prepare, profile, scaling, scenario, split
from riskspark.plans import preparation, promotion, scoring, training
from riskspark.sources import files, runs
from riskspark.spec import GRIDS, REGIONAL, JobSpec

SMALL = replace(REGIONAL, grids={
    "LinearRegression": GRIDS["LinearRegression"],
    "DecisionTreeRegressor": {"maxDepth": (2, 3)},
    "GradientBoostingRegressor": {"maxDepth": (2,), "maxIter": (2,)}})


@pytest.fixture(scope="module")
def items(spark, sf):
    return fx(spark, sf).persist()


def test_grids_have_27_points():
    sizes = {m: len(REGIONAL.grid_points(m)) for m in REGIONAL.grids}
    assert list(sizes.values()) == [6, 9, 8, 4]
    assert REGIONAL.grid_points("LinearRegression")[1] == {"regParam": 0.01, "elasticNetParam": 0.5}


def test_spec_is_checked():
    with pytest.raises(ValueError):
        JobSpec(features=(), target="y")
    with pytest.raises(ValueError):
        JobSpec(features=("y",), target="y")
    with pytest.raises(ValueError):
        JobSpec(features=("x",), target="y", test_size=1.0)


def test_hash_split_ignores_partitioning(items):
    one = split.hash_split(items, "id", FX).select("id", "split")
    many = split.hash_split(items.repartition(7), "id", FX).select("id", "split")
    assert one.exceptAll(many).count() == 0
    share = one.where("split = 'train'").count() / one.count()
    assert 0.77 < share < 0.83


def test_random_scenario_seeded_is_within_bounds(items):
    out = scenario.random_scenario_seeded(items.select("id"), ["a", "b"], 7)
    row = out.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert tuple(row) == (1, 10, 1, 10)


def test_scaled_train_rows_are_standard(items):
    train = split.hash_split(items, "id", FX).where("split = 'train'")
    scaled = scaling.apply_scaler(train, scaling.fit_scaler(train, FX.features))
    row = profile.moments(scaled, FX.features).first()
    for f in FX.features:
        assert abs(row[f"{f}_mean"]) < 1e-9 and abs(row[f"{f}_std"] - 1) < 1e-9


def test_constant_and_single_row_scaling(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "a double, b int")
    scaler = scaling.fit_scaler(df, ["a", "b"])
    assert np.allclose([scaler.means[0], scaler.stds[0]], [7 / 3, 1.527525], atol=1e-6)
    assert {r["b"] for r in scaling.apply_scaler(df, scaler).collect()} == {0.0}
    assert {r["b"] for r in scaling.standardise(df, ["a", "b"], df).collect()} == {0.0}
    one = df.limit(1)
    assert scaling.standardise(one, ["a"], one).first()["a"] == 0.0
    with pytest.raises(ValueError):
        scaling.fit_scaler(df.limit(0), ["a"])


def test_duplicates_of_null_nan_and_zero(spark):
    rows = [(None,), (None,), (float("nan"),), (float("nan"),), (0.0,), (-0.0,), (1.0,)]
    df = spark.createDataFrame(rows, "a double")
    assert profile.duplicate_rows(df).first()[0] == 3
    assert profile.null_counts(df).first()[0] == 4
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0


def test_metrics_agree_with_each_other(items):
    df = items.withColumn("mean", F.lit(items.agg(F.avg("y")).first()[0]))
    row = evaluate.evaluate(df, "y", "mean").first()
    assert abs(row["r2"]) < 1e-9 and abs(row["rmse"] ** 2 - row["mse"]) < 1e-12


def test_champion_ties_and_nan(spark):
    rows = [("a", 0, float("nan")), ("b", 1, 0.5), ("c", 2, 0.5)]
    df = spark.createDataFrame(rows, "model string, ordinal int, Test_RMSE double")
    assert evaluate.champion(df).first()["model"] == "b"
    noisy = df.withColumn("Test_RMSE", F.col("Test_RMSE") - F.col("ordinal") * 1e-15)
    assert evaluate.champion(noisy).first()["model"] == "b"
    assert evaluate.champion(noisy, places=17).first()["model"] == "c"
    assert evaluate.champion(df.limit(1)).first() is None
    with pytest.raises(ValueError):
        models.SearchResult("m", [{}], [float("nan")]).best


def test_linear_search_ignores_the_scale(items):
    df = split.assign_folds(items, "id", FX)
    scaled = scaling.apply_scaler(df, scaling.fit_scaler(df, FX.features))
    raw, std = (models.grid_search(prepare.assemble(t, FX.features).persist(), "LinearRegression", FX)
                for t in (df, scaled))
    assert np.allclose(raw.avg_rmse, std.avg_rmse, atol=1e-6)
    assert raw.best == std.best


def test_linear_search_reads_the_rows_twice_whatever_the_grid(spark, items, monkeypatch):
    """The fits see a few rows with the moments of their folds, and come out as on all rows."""
    train = prepare.assemble(split.assign_folds(items, "id", FX), FX.features).persist()
    seen = []
    make = models.make_estimator

    def watched(*args):
        estimator = make(*args)
        fit = estimator.fit
        estimator.fit = lambda rows: (seen.append(rows.count()), fit(rows))[1]
        return estimator

    with monkeypatch.context() as patched:
        patched.setattr(models, "make_estimator", watched)
        found = models.grid_search(train, "LinearRegression", FX)
    assert len(seen) == 18 and max(seen) == 2 * (len(FX.features) + 1)
    for i, point in enumerate(found.points):
        rmse = []
        for k in range(FX.folds):
            model = models.make_estimator("LinearRegression", FX, point).fit(train.where(F.col("fold") != k))
            rmse.append(model.transform(train.where(F.col("fold") == k))
                        .agg(evaluate.metric("rmse", "y", "prediction")).first()[0])
        assert abs(found.avg_rmse[i] - np.mean(rmse)) < 1e-11
    train.unpersist()


def test_rows_of_moments():
    rows = np.random.default_rng(5).normal(size=(500, 3)) @ np.diag([1e-4, 1.0, 1e5]) + [3.0, 0.0, 1e6]
    rows = np.column_stack([rows, rows[:, 1], np.full(500, 7.0)])  # a repeated and a constant column

    def moments(part):
        apart = part - part.mean(0)
        return len(part), part.mean(0), apart.T @ apart

    whole = models.merged_moments([moments(rows[:100]), moments(rows[100:101]), moments(rows[101:])])
    few, weight = models.rows_of_moments(*whole)
    assert np.isclose(weight * len(few), 500) and np.allclose(few.mean(0), rows.mean(0), rtol=1e-12)
    unit = np.where(rows.std(0) > 0, rows.std(0), 1)
    apart = (few - rows.mean(0)) / unit
    assert np.allclose(apart.T @ apart / len(few), moments(rows)[2] / 500 / np.outer(unit, unit), atol=1e-9)
    assert models.merged_moments([(1, np.array([np.nan]), np.array([[0.0]]))]) is None


def test_linear_search_on_a_missing_target_is_an_error(spark):
    spec = JobSpec(features=("x",), target="y")
    rows = spark.createDataFrame([(float(i), None if i == 7 else 2.0 * i, i % 3) for i in range(30)],
                                 "x double, y double, fold int")
    with pytest.raises(Exception, match="(?i)label|null"):
        models.grid_search(prepare.assemble(rows, ["x"]), "LinearRegression", spec)


def test_trees_repeat_with_their_seed(items):
    train = prepare.assemble(items, FX.features)
    fits = [models.make_estimator("RandomForestRegressor", FX, {"numTrees": 3, "maxDepth": 3}).fit(train)
            for _ in range(2)]
    assert fits[0].toDebugString.split("\n")[1:] == fits[1].toDebugString.split("\n")[1:]


@pytest.mark.parametrize("preset", ["Ridge", "Lasso"])
def test_presets(items, preset):
    assert models.make_preset(preset, FX).fit(prepare.assemble(items, FX.features)).intercept


def test_predictive_stage(items):
    train = items.limit(200)
    for name, kind in (("LinearRegression", "linear"), ("DecisionTreeRegressor", "tree")):
        assert models.predictive_stage(models.fit_model(train, FX, name))[0] == kind
    with pytest.raises(ValueError):
        models.predictive_stage(scaling.fit_scaler_model(train, FX.features))
    with pytest.raises(ValueError):
        models.linear_weights(models.fit_model(train, FX, "DecisionTreeRegressor"), FX.features)


@pytest.mark.parametrize("name", ["LinearRegression", "DecisionTreeRegressor"])
@pytest.mark.parametrize("scaled", [True, False])
def test_scoring_equals_the_model(items, name, scaled):
    model = models.fit_model(items, FX, name)
    ours = scoring.score_table(items, model, FX, scaled=scaled)
    if scaled:
        theirs = model.transform(items)
    else:
        stage = model.stages[-1]
        theirs = stage.transform(prepare.assemble(items, FX.features))
    both = ours.select("id", F.col("prediction").alias("a")).join(
        theirs.select("id", F.col("prediction").alias("b")), "id")
    assert both.where("abs(a - b) > 1e-6 * greatest(abs(b), 1)").count() <= 2  # one id pair collides


def test_linear_scoring_stays_in_generated_code(items):
    model = models.fit_model(items, FX)
    plan = scoring.score_table(items.drop("y"), model, FX)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_model_folder_checks(spark, items, tmp_path):
    with pytest.raises(FileNotFoundError, match="no model"):
        runs.load_model(spark, f"{tmp_path}/none")
    bare = models.fit_model(items.limit(50), FX).stages[-1]
    bare.write().overwrite().save(f"{tmp_path}/bare")
    with pytest.raises(FileNotFoundError, match="incomplete: no stages"):
        runs.load_model(spark, f"{tmp_path}/bare")
    runs.save_model(bare, f"{tmp_path}/wrapped")
    assert isinstance(runs.load_model(spark, f"{tmp_path}/wrapped"), PipelineModel)


def test_champion_pointer_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        runs.read_champion(spark, f"{tmp_path}/champion")
    runs.write_champion(spark.createDataFrame([("  ",)], "run_id string"), f"{tmp_path}/champion")
    with pytest.raises(ValueError):
        runs.read_champion(spark, f"{tmp_path}/champion")


def test_lineage_edges(spark):
    schema = "start_time int, run_id string"
    preps = spark.createDataFrame([(5, "p5"), (9, "p9")], schema)
    trains = spark.createDataFrame([(4, "t4"), (5, "t5"), (8, "t8"), (9, "t9")], schema)
    got = {r["run_id"]: r["preprocessing_run_id"] for r in runs.lineage(trains, preps, []).collect()}
    assert got == {"t4": None, "t5": "p5", "t8": "p5", "t9": "p9"}


def test_whole_job(spark, sf, tmp_path):
    """Prepare, train, promote twice, score: from raw CSV to banded responses."""
    root = str(tmp_path / "job")
    files.write_csv(rx(spark, sf).drop("id"), f"{root}/raw")
    raw = files.read_csv(spark, f"{root}/raw")
    prepared = preparation.prepare(raw, SMALL, root)
    assert sum(prepared.sizes.values()) == raw.count()

    run_id = training.train(prepared, SMALL, root, "2024-01-01 00:00:00")
    log = runs.read_runs(spark, f"{root}/runs")
    assert log.where("experiment = 'Training'").count() == len(SMALL.grids) + 1
    trained = log.where("run_name = 'LinearRegression'").first()
    assert trained["params"]["preprocessing_run_id"] == prepared.run_id
    assert {"regParam", "elasticNetParam"} <= trained["params"].keys()
    assert {"Train_R2", "Test_MAE"} <= trained["metrics"].keys()
    history = runs.flat_scores(runs.read_scores(spark, f"{root}/scores"))
    assert history.count() == len(SMALL.grids)
    assert history.where("best_model = model").first()["Test_RMSE"] == history.agg(
        F.min("Test_RMSE")).first()[0]

    assert runs.read_champion(spark, f"{root}/champion") == run_id
    assert [promotion.promote_champion(spark, root) for _ in range(2)] == [1, 2]
    model = runs.load_model(spark, f"{root}/models/best_model_latest")
    asked = rx(spark, sf).select("id", *REGIONAL.features)
    good, bad = scoring.score_requests(asked, ["id"], model, REGIONAL, low=1, high=10)
    assert good.count() == asked.count() and bad.count() == 0
    assert good.where("band is null or status <> 'success'").count() == 0


def test_failed_preparation_is_logged(spark, sf, tmp_path):
    with pytest.raises(ValueError):
        preparation.prepare(rx(spark, sf).drop("Watersheds"), REGIONAL, str(tmp_path))
    row = runs.read_runs(spark, f"{tmp_path}/runs").first()
    assert row["tags"]["status"] == "failed"


KINDS = [("DecisionTreeRegressor", {"maxDepth": 4}), ("RandomForestRegressor", {"maxDepth": 4, "numTrees": 5}),
         ("GradientBoostingRegressor", {"maxDepth": 3, "maxIter": 4, "stepSize": 0.3})]


@pytest.mark.parametrize("name, params", KINDS)
def test_tree_models_as_expressions(spark, items, name, params):
    model = models.fit_model(items, FX, name, params, scaled=False)
    nodes = models.node_table(spark, model, FX.features)
    scored = model.transform(items.withColumn("own", models.tree_score(nodes.collect())))
    assert scored.where(F.abs(F.col("own") - F.col("prediction")) > 1e-9).count() == 0
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    own = models.gain_importances(nodes, FX.features, per_tree=name.startswith("R")).collect()
    spark_own = models.importance_table(spark, model, FX.features).collect()
    assert {r.feature: round(r.importance, 9) for r in own} == {r.feature: round(r.importance, 9) for r in spark_own}


def test_a_tree_without_a_split(spark, items):
    flat = items.withColumn("y", F.lit(0.5))
    model = models.fit_model(flat, FX, "DecisionTreeRegressor", {"maxDepth": 3}, scaled=False)
    nodes = models.node_table(spark, model, FX.features)
    assert [tuple(r)[:4] for r in nodes.collect()] == [(0, 1, None, None)]
    assert flat.select(models.tree_score(nodes.collect()).alias("p")).distinct().collect()[0].p == 0.5
    with pytest.raises(ValueError, match="tree"):
        models.node_table(spark, models.fit_model(items, FX), FX.features)


def test_fold_scalers_see_the_other_folds_only(items):
    folded = split.assign_folds(items, "id", FX)
    found = scaling.fold_scalers(folded, FX.features)
    for k in range(3):
        want = scaling.fit_scaler(folded.where(F.col("fold") != k), FX.features)
        assert np.allclose(found[k].means, want.means, rtol=1e-12)
        assert np.allclose(found[k].stds, want.stds, rtol=1e-10)
    with pytest.raises(ValueError, match="outside fold"):
        scaling.fold_scalers(folded.where("fold = 1"), FX.features)


def test_tournament_with_scalers_inside_the_folds(items):
    spec = replace(FX, grids={"LinearRegression": {"regParam": (0.01, 0.1)}, "DecisionTreeRegressor": {"maxDepth": (2,)}})
    rows = split.assign_folds(split.hash_split(items, "id", spec), "id", spec)
    raw = training.tournament(rows.select(*spec.kept, "split", "fold"), spec, scaled=False, partitions=4)
    scaler = scaling.fit_scaler(rows.where("split = 'train'"), spec.features)
    whole = training.tournament(scaling.apply_scaler(rows, scaler).select(*spec.kept, "split", "fold"), spec)
    for a, b in zip(raw.scores.orderBy("ordinal").collect(), whole.scores.orderBy("ordinal").collect(), strict=True):
        assert a["model"] == b["model"] and abs(a["Test_RMSE"] - b["Test_RMSE"]) < 1e-6
    assert raw.searches["DecisionTreeRegressor"].avg_rmse != [] and len(raw.searches["LinearRegression"].avg_rmse) == 2


def test_promotions_at_once_get_versions_of_their_own(spark, items, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    model = models.fit_model(items, FX)
    store = f"{tmp_path}/models"
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda i: runs.promote(spark, model, store, f"run-{i}", "a", 0.1, "m"), range(4)))
    assert sorted(found) == [1, 2, 3, 4]
    assert runs.read_registry(spark, f"{store}/registry").select("version").distinct().count() == 4
    assert isinstance(runs.load_model(spark, f"{store}/best_model_latest"), PipelineModel)
    assert runs.claim_version(spark, store) == 5 and runs.promote(spark, model, store, "r", "a", 0.1, "m") == 6


def test_a_pointer_is_there_while_another_is_written(spark, tmp_path):
    path = f"{tmp_path}/champion"
    assert runs.write_champion(spark.createDataFrame([("one",)], "run_id string"), path) == 1
    runs.claim_version(spark, path)  # a writer that has not finished
    (tmp_path / "champion" / "2").mkdir()
    assert runs.read_champion(spark, path) == "one"
    assert runs.write_champion(spark.createDataFrame([("two",)], "run_id string"), path) == 3
    assert runs.read_champion(spark, path) == "two"


def test_claims_are_exclusive(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda _: runs.claim_version(spark, f"{tmp_path}/x"), range(24)))
    assert sorted(found) == list(range(1, 25))


def test_duplicates_move_digests(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (1, "a", float("nan")), (1, "a", float("nan")), (2, "a", 1.0), (None,) * 3]
    df = spark.createDataFrame(rows * 2 + [(3, "z", 2.0)], "a int, `b.c` string, d double")
    assert profile.duplicate_rows(df).first().duplicates == 13 - df.distinct().count()
    assert profile.duplicate_rows(df.limit(0)).first().duplicates == 0
