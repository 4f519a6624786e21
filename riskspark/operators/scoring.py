"""Scoring of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.operators.models import LinearWeights
from riskspark.spec import JobSpec


def score_linear(df: DataFrame, weights: LinearWeights, link: str = "identity",
                 out: str = "prediction") -> DataFrame:
    """Linear score as one arithmetic expression over the feature columns."""
    return df.withColumn(out, C.link(
        C.linear_score(weights.features, weights.coefficients, weights.intercept), link))


def score_array(df: DataFrame, values: str, coefficients: Sequence[float], intercept: float,
                link: str = "identity", out: str = "prediction") -> DataFrame:
    """Linear score of an array column."""
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    return df.withColumn(out, C.link(C.dot(values, weights) + F.lit(float(intercept)), link))


def score_model(df: DataFrame, model: PipelineModel, link: str = "identity",
                out: str = "prediction") -> DataFrame:
    """Score with any saved model (trees included), keeping the input columns."""
    scored = model.transform(df)
    return scored.select(*df.columns, C.link("prediction", link).alias(out))


def with_bands(df: DataFrame, spec: JobSpec, score: str = "prediction") -> DataFrame:
    """Add ``band``, ``advice`` and the capped ``percent`` of a score."""
    return df.withColumns({
        "band": C.risk_band(score, spec.bands),
        "advice": C.risk_advice(score, spec.bands),
        "percent": C.percent(score),
    })


def band_report(df: DataFrame, score: str = "prediction", band: str = "band") -> DataFrame:
    """Rows and mean score per band."""
    return df.groupBy(band).agg(F.count(F.lit(1)).alias("n_rows"),
                                F.avg(score).alias("avg_score"))


def responses(df: DataFrame, ids: Sequence[str], n_features: int,
              score: str = "prediction") -> DataFrame:
    """Response rows ``(ids, prediction, features_used, status)``."""
    return df.select(*ids, F.col(score).alias("prediction"),
                     F.lit(n_features).alias("features_used"), F.lit("success").alias("status"))
