"""Preparation job: raw table -> profiled, split, standardised, written rows and a saved scaler."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.prepare import drop_columns, select_features
from riskspark.operators.profile import split_sizes
from riskspark.operators.scaling import apply_scaler, fit_scaler_model, scaler_of
from riskspark.operators.split import assign_folds, hash_split
from riskspark.sources.files import read_prepared, write_prepared
from riskspark.sources.runs import log_run, save_model
from riskspark.spec import JobSpec

EXPERIMENT = "Preprocessing"


@dataclass(frozen=True)
class Prepared:
    run_id: str
    data_path: str
    scaler_path: str
    sizes: dict[str, int]


def keyed(df: DataFrame, spec: JobSpec, key: str | None) -> DataFrame:
    """Kept columns with a text key ``_key``; without a key column the row's values are the key."""
    if key:
        kept = select_features(df, spec, [key])
        return kept.withColumn("_key", F.col(key).cast("string")).select("_key", *spec.kept)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in spec.kept]
    return select_features(df, spec).withColumn("_key", F.concat_ws("|", *values))


def prepare(raw: DataFrame, spec: JobSpec, root: str, key: str | None = None) -> Prepared:
    """Run the job. The rows are read twice: once for the scaler, once to be written.

    Sizes are counted on the written rows, where only the partition column is read.
    """
    spark = raw.sparkSession
    params = {"num_features": len(spec.features), "target_col": spec.target,
              "drop_cols": ",".join(spec.dropped), "test_size": spec.test_size,
              "random_state": spec.seed, "scaler": "StandardScaler(withMean=True, withStd=True)"}
    tags = {"stage": "preprocessing", "framework": "pyspark"}
    try:
        rows = (drop_columns(raw, spec.dropped)
                .transform(keyed, spec, key)
                .transform(hash_split, "_key", spec)
                .transform(assign_folds, "_key", spec)
                .drop("_key"))
        model = fit_scaler_model(rows.where("split = 'train'"), spec.features, "features")
        data_path, scaler_path = f"{root}/prepared", f"{root}/scaler"
        write_prepared(apply_scaler(rows, scaler_of(model, spec.features)), data_path, ["split"])
        save_model(model, scaler_path)
        sizes = {r["split"]: r["n_rows"]
                 for r in split_sizes(read_prepared(spark, data_path)).collect()}
    except Exception:
        log_run(spark, f"{root}/runs", EXPERIMENT, "preprocessing", params,
                tags={**tags, "status": "failed"})
        raise
    metrics = {"raw_rows": sum(sizes.values()), "raw_cols": len(raw.columns),
               "train_rows": sizes.get("train", 0), "test_rows": sizes.get("test", 0)}
    run_id = log_run(spark, f"{root}/runs", EXPERIMENT, "preprocessing", params, metrics,
                     {**tags, "status": "success"})
    return Prepared(run_id, data_path, scaler_path, sizes)
