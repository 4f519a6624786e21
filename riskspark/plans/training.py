"""Training job: cross-validated tournament, metrics, diagnosis, champion, score history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskspark.operators.evaluate import (SCORE_NAMES, champion, diagnose, evaluate_models,
                                          score_table)
from riskspark.operators.models import (SearchResult, fit_trees, grid_search, make_estimator,
                                        tree_rows)
from riskspark.operators.prepare import assemble
from riskspark.operators.scaling import apply_scaler, fit_scaler, fold_scalers
from riskspark.operators.trees import WRITER
from riskspark.plans.preparation import Prepared
from riskspark.session import delete_work, work_path
from riskspark.sources import runs as R
from riskspark.spec import JobSpec

EXPERIMENT = "Training"


@dataclass(frozen=True)
class Tournament:
    """Score table (one row per model), fitted regressors and search results by model name."""

    scores: DataFrame
    models: dict[str, object]
    searches: dict[str, SearchResult]


def tournament(rows: DataFrame, spec: JobSpec, parallelism: int = 4, scaled: bool = True,
               partitions: int | None = None) -> Tournament:
    """Search, refit and score every model of the job.

    With ``scaled=False`` the features are raw: each fold is standardised by the other folds'
    training rows, and the refitted models by all training rows, so no held-out row has a part
    in any scaler. ``partitions`` deals the rows out first, for sources that come in few parts.

    ``rows`` holds standardised features, target, ``split`` and ``fold``. They are written to a
    work table once: Spark's cache ran out of heap where a task has millions of them. The driver
    loops over estimators only; all trees of a grid grow in the same scans of the coded rows, and
    all models are then scored and measured on both splits in a single pass.
    """
    spark = rows.sparkSession
    rows = rows.repartition(partitions) if partitions else rows
    path, coded, tried = work_path(spark, "tournament"), None, False
    try:
        rows.select(*spec.kept, "split", "fold").write.options(**WRITER).parquet(path)
        rows = spark.read.parquet(path)
        scalers, whole = None, rows
        if not scaled:
            folded = rows.where("split = 'train'").select(*spec.kept, "fold")
            scalers = fold_scalers(folded, spec.features)
            whole = apply_scaler(rows, fit_scaler(folded, spec.features))
        vectors = assemble(whole, spec.features).select("features", *spec.kept, "split", "fold")
        # Numbers reach Python as they are; the vector is for Spark's estimators and models.
        values = (F.array(*[F.col(f).cast("double") for f in spec.features])
                  if all(isinstance(whole.schema[f].dataType, NumericType) for f in spec.features) else None)
        train = vectors.where("split = 'train'")
        searches, models, scored = {}, {}, vectors
        if train.isEmpty():
            raise ValueError("no training rows")
        if scaled:
            folded = train.drop("split")
        for name in spec.grids:
            linear = name == "LinearRegression"
            if not linear and not tried:
                coded, tried = tree_rows(train, spec, whole=True, values=values), True
            if linear or coded is None:
                searches[name] = grid_search(folded, name, spec, parallelism=parallelism, scalers=scalers,
                                             values=values)
            else:
                searches[name] = grid_search(train, name, spec, coded=coded)
            best = searches[name].points[searches[name].best]
            models[name] = (make_estimator(name, spec, best).fit(train) if linear or coded is None
                            else fit_trees(coded, name, spec, best))
            scored = models[name].copy().setPredictionCol(name).transform(scored)
        metrics = evaluate_models(scored, spec.target, {n: n for n in models}, ["split"])
        order = F.create_map(*[F.lit(v) for pair in ((n, i) for i, n in enumerate(models))
                               for v in pair])
        table = diagnose(score_table(metrics)).withColumn("ordinal", order[F.col("model")])
        # One row per model: fix the figures, so that later reads do not score again.
        scores = spark.createDataFrame(table.collect(), table.schema)
    finally:
        if coded is not None:
            coded.drop()
        delete_work(spark, path)
    return Tournament(scores, models, searches)


def with_scaler(scaler: PipelineModel, regressor) -> PipelineModel:
    """One saved unit from raw columns to prediction."""
    return PipelineModel(stages=[*scaler.stages, regressor])


def train(prepared: Prepared, spec: JobSpec, root: str, run_timestamp: str,
          parallelism: int = 4) -> str:
    """Run the job on prepared rows; returns the champion's run id."""
    spark = SparkSession.active()
    runs_path = f"{root}/runs"
    preparation_id = prepared.run_id

    result = tournament(spark.read.parquet(prepared.data_path), spec, parallelism)
    scaler = R.load_model(spark, prepared.scaler_path)
    shared = {"test_size": spec.test_size, "random_state": spec.seed,
              "num_features": len(spec.features), "target_col": spec.target,
              "cv_folds": spec.folds}
    if preparation_id:
        shared["preprocessing_run_id"] = preparation_id
    for row in result.scores.orderBy("ordinal").collect():
        name, search = row["model"], result.searches[row["model"]]
        metrics = {n: row[n] for n in SCORE_NAMES}
        metrics["overfit_gap"] = row["overfit_gap"]
        run_id = R.log_run(spark, runs_path, EXPERIMENT, name,
                           {**shared, "model_name": name, **search.points[search.best]}, metrics,
                           {"fit_status": row["fit_status"], "model_type": name,
                            "framework": "pyspark", "status": "success"})
        R.log_model(with_scaler(scaler, result.models[name]), root, run_id)

    best = champion(result.scores).first()
    if best is None:
        raise ValueError("no model has a usable test score")
    name, rmse = best["model"], best["Test_RMSE"]
    params = {"best_model_name": name}
    if preparation_id:
        params["preprocessing_run_id"] = preparation_id
    run_id = R.log_run(spark, runs_path, EXPERIMENT, f"Best_Model_{name}", params,
                       {"best_RMSE": rmse},
                       {"stage": "champion", "model_type": name, "framework": "pyspark"})
    R.log_model(with_scaler(scaler, result.models[name]), root, run_id, "best_model")
    R.write_champion(spark.createDataFrame([(run_id,)], "run_id string"), f"{root}/champion")
    R.append_scores(R.score_record(result.scores, run_timestamp, name, run_id, rmse,
                                   preparation_id), f"{root}/scores")
    return run_id
