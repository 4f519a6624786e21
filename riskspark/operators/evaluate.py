"""Regression metrics, fit diagnosis and champion choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.operators.ordered import running_fold

METRICS = ("r2", "rmse", "mse", "mae")
# Names of the eight figures kept per model.
SCORE_NAMES = ("Train_R2", "Test_R2", "Train_RMSE", "Test_RMSE",
               "Train_MSE", "Test_MSE", "Train_MAE", "Test_MAE")


def metric(name: str, label: str | Column, prediction: str | Column) -> Column:
    """Aggregate expression of one metric."""
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    error = y - p
    if name == "r2":
        return F.lit(1.0) - F.sum(error * error) / (F.var_pop(y) * F.count(error))
    if name == "rmse":
        return F.sqrt(F.avg(error * error))
    if name == "mse":
        return F.avg(error * error)
    if name == "mae":
        return F.avg(F.abs(error))
    raise ValueError(f"unknown metric {name!r}")


def evaluate(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """All metrics of a prediction column in one pass, per group."""
    return df.groupBy(*by).agg(*[metric(m, label, prediction).alias(m) for m in METRICS])


def evaluate_models(df: DataFrame, label: str, predictions: dict[str, str],
                    by: Sequence[str] = ("split",)) -> DataFrame:
    """All metrics of several prediction columns: one scan, rows ``(by..., model, metrics)``.

    The models stay columns until after the aggregate, so the scored rows are not multiplied.
    """
    sums = [metric(m, label, p).alias(f"{m}_{i}")
            for i, p in enumerate(predictions.values()) for m in METRICS]
    entries = F.array(*[
        F.struct(F.lit(name).alias("model"), *[F.col(f"{m}_{i}").alias(m) for m in METRICS])
        for i, name in enumerate(predictions)])
    return df.groupBy(*by).agg(*sums).select(*by, F.inline(entries))


def score_table(metrics: DataFrame, split: str = "split") -> DataFrame:
    """One row per model with the eight figures ``Train_R2`` ... ``Test_MAE``."""
    return metrics.groupBy("model").agg(*[
        F.max(F.when(F.col(split) == part.lower(), F.col(m.lower()))).alias(f"{part}_{m}")
        for part, m in (name.split("_") for name in SCORE_NAMES)])


def rounded_scores(scores: DataFrame, places: int = 4) -> DataFrame:
    return scores.withColumns({n: F.round(n, places) for n in SCORE_NAMES})


def diagnose(scores: DataFrame, train_r2: str = "Train_R2", test_r2: str = "Test_R2") -> DataFrame:
    """Add ``fit_status`` and ``overfit_gap``."""
    return (scores.withColumn("fit_status", C.fit_status(train_r2, test_r2))
            .withColumn("overfit_gap", C.overfit_gap(train_r2, test_r2)))


def best_grid_point(results: DataFrame, by: Sequence[str] = (), score: str = "avg_rmse",
                    grid_id: str = "grid_id") -> DataFrame:
    """The grid point with the lowest mean score, the first one on ties; NaN is no score."""
    usable = results.where(~F.isnan(score) & F.col(score).isNotNull())
    best = F.min(F.struct(score, grid_id))
    return usable.groupBy(*by).agg(best.alias("_best")).select(*by, f"_best.{grid_id}", f"_best.{score}")


def champion(scores: DataFrame, by: Sequence[str] = (), score: str = "Test_RMSE",
             ordinal: str = "ordinal", name: str = "model", places: int = 12) -> DataFrame:
    """The model with the lowest score, the first one on ties. No row when none is usable.

    Scores that agree when rounded to ``places`` decimals are ties: the scores of equal models
    differ by the order of their sums alone.
    """
    usable = scores.where(~F.isnan(score) & F.col(score).isNotNull())
    ranked = F.struct(F.round(score, places).alias("_rounded"), ordinal, name, score)
    best = usable.groupBy(*by).agg(F.min(ranked).alias("_best"))
    return (best.where("_best is not null")
            .select(*by, f"_best.{name}", f"_best.{ordinal}", f"_best.{score}"))


def new_best_events(runs: DataFrame, keys: Sequence[str], order: Sequence[str],
                    score: str) -> DataFrame:
    """Add ``best_before`` (running minimum of earlier scores) and ``new_best``."""
    value = F.when(~F.isnan(score), F.col(score))
    folded = running_fold(runs, keys, order, {"best_before": ("min", value)}, include_current=False)
    better = F.col("best_before").isNull() | (F.col(score) < F.col("best_before"))
    return folded.withColumn("new_best", F.coalesce(better & ~F.isnan(score), F.lit(False)))
