"""Promotion job: champion run -> next model version and the latest model."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskspark.sources import runs as R


def promote_champion(spark: SparkSession, root: str, model_name: str = "risk_model") -> int:
    """Store the champion's model as a new version; any failure is raised."""
    run_id = R.read_champion(spark, f"{root}/champion")
    pointer = spark.createDataFrame([(run_id,)], "run_id string")
    details = R.with_run_details(pointer, R.read_runs(spark, f"{root}/runs")).first()
    model = R.load_model(spark, f"{root}/artifacts/{run_id}/best_model")
    return R.promote(spark, model, f"{root}/models", run_id, details["algorithm"],
                     details["best_rmse"], model_name)
