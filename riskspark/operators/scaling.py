"""Standardisation with statistics of the training rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.profile import moments


@dataclass(frozen=True)
class Scaler:
    """Means and sample deviations, one pair per feature."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]


def fit_scaler(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Read the moments of the training rows: one aggregate, one row to the driver."""
    row = moments(train, features).first()
    if row is None or any(row[f"{f}_mean"] is None for f in features):
        raise ValueError("cannot fit a scaler without training rows")
    return Scaler(tuple(features),
                  tuple(row[f"{f}_mean"] for f in features),
                  tuple(row[f"{f}_std"] or 0.0 for f in features))


def fold_scalers(train: DataFrame, features: Sequence[str], fold: str = "fold") -> dict[int, Scaler]:
    """For each fold the scaler of the other folds' rows, from one pass.

    The pass gives each fold's number, mean and sum of squared deviations of every feature;
    those of the other folds are merged. A fold whose others hold no row of some feature is an
    error; a row without a fold belongs to no fold and takes no part.
    """
    rows = train.where(F.col(fold).isNotNull()).groupBy(F.col(fold).alias("_fold")).agg(*[
        F.struct(F.count(f).alias("n"), F.avg(F.col(f).cast("double")).alias("mean"),
                 F.var_pop(F.col(f).cast("double")).alias("variance")).alias(f"_{i}")
        for i, f in enumerate(features)]).collect()  # one row a fold
    scalers = {}
    for row in rows:
        means, stds = [], []
        for i, f in enumerate(features):
            n, mean, squares = 0, 0.0, 0.0
            for other in rows:
                part = other[f"_{i}"]
                if other["_fold"] == row["_fold"] or not part["n"]:
                    continue
                apart, both = part["mean"] - mean, n + part["n"]
                squares += part["variance"] * part["n"] + apart * apart * n * part["n"] / both
                mean, n = mean + apart * part["n"] / both, both
            if not n:
                raise ValueError(f"no rows of {f} outside fold {row['_fold']}")
            means.append(mean)
            stds.append((squares / (n - 1)) ** 0.5 if n > 1 else 0.0)
        scalers[row["_fold"]] = Scaler(tuple(features), tuple(means), tuple(stds))
    return scalers


def scaled(feature: str, mean, std):
    """(x - mean) / std, and 0 for a feature that does not vary."""
    value = F.col(feature).cast("double")
    return F.when(std == 0, F.lit(0.0)).otherwise((value - mean) / std)


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Standardise the features in place with known statistics, as plain arithmetic."""
    return df.withColumns({
        f: scaled(f, F.lit(m), F.lit(s))
        for f, m, s in zip(scaler.features, scaler.means, scaler.stds)})


def standardise(df: DataFrame, features: Sequence[str], train: DataFrame) -> DataFrame:
    """Standardise in one plan: the training moments are a scalar subquery, not a join."""
    stats = moments(train, features)
    one = stats.select(F.struct(*stats.columns)).scalar()
    return (df.withColumn("_moments", one).withColumns({
        f: scaled(f, F.col(f"_moments.{f}_mean"), F.coalesce(f"_moments.{f}_std", F.lit(0.0)))
        for f in features}).drop("_moments"))


def scaler_stages(features: Sequence[str], out: str = "features",
                  handle_invalid: str = "error") -> list:
    """Assembler and scaler, to be put in front of a regressor."""
    return [
        VectorAssembler(inputCols=list(features), outputCol="features_raw",
                        handleInvalid=handle_invalid),
        StandardScaler(inputCol="features_raw", outputCol=out, withMean=True, withStd=True),
    ]


def fit_scaler_model(train: DataFrame, features: Sequence[str],
                     out: str = "features_scaled") -> PipelineModel:
    """Fit the two stages as a pipeline model that can be saved."""
    return Pipeline(stages=scaler_stages(features, out)).fit(train)


def scaler_of(model: PipelineModel, features: Sequence[str]) -> Scaler:
    """The statistics of a fitted scaler stage, for use as plain arithmetic."""
    stage = next(s for s in model.stages if hasattr(s, "mean") and hasattr(s, "std"))
    return Scaler(tuple(features), tuple(float(v) for v in stage.mean),
                  tuple(float(v) for v in stage.std))
