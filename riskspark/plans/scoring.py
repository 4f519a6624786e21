"""Batch scoring job: requests -> validated, scored, banded responses and rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from riskspark.operators.models import linear_weights, predictive_stage
from riskspark.operators.prepare import accepted, rejected, validate
from riskspark.operators.scoring import responses, score_linear, score_model, with_bands
from riskspark.spec import JobSpec


def score_table(df: DataFrame, model: PipelineModel, spec: JobSpec, link: str = "identity",
                scaled: bool = True) -> DataFrame:
    """Add ``prediction``.

    A linear model becomes one arithmetic expression with its scaler folded in, so the
    scan, the score and whatever follows share one generated stage. Other models go
    through their pipeline. ``scaled=False`` feeds raw values to the regressor.
    """
    kind, stage = predictive_stage(model)
    if kind == "linear":
        return score_linear(df, linear_weights(model, spec.features, scaled), link)
    if not scaled:
        regressor = PipelineModel(stages=[
            model.stages[0].copy().setOutputCol(stage.getFeaturesCol()), stage])
        return score_model(df, regressor, link)
    return score_model(df, model, link)


def score_requests(df: DataFrame, ids: Sequence[str], model: PipelineModel, spec: JobSpec,
                   link: str = "identity", scaled: bool = True, low: float | None = None,
                   high: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Responses with risk bands for good requests, and rejects with their reasons."""
    checked = validate(df, spec.features, low, high)
    scored = score_table(accepted(checked, spec.features), model, spec, link, scaled)
    answered = responses(scored, ids, len(spec.features)).transform(with_bands, spec)
    return answered, rejected(checked).select(*ids, "reason")
