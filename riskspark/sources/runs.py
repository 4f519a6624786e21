"""Run log, score history, champion pointer and model store, all as tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.operators.evaluate import SCORE_NAMES
from riskspark.operators.ordered import running_fold

RUN_SCHEMA = ("run_id string, experiment string, run_name string, start_time timestamp, "
              "params map<string,string>, metrics map<string,double>, tags map<string,string>")
SCORES_SCHEMA = ("run_timestamp string, best_model string, best_run_id string, best_rmse double, "
                 "preprocessing_run_id string, models map<string, struct<"
                 + ", ".join(f"{n}: double" for n in SCORE_NAMES) + ">>")
REGISTRY_SCHEMA = ("model_name string, algorithm string, run_id string, best_rmse double, "
                   "version int, versioned_path string, latest_path string, "
                   "completed_at timestamp")
# --- Fixed values: names in the model store and of a run without a model. ---
VERSION_PREFIX = "best_model_v"
LATEST = "best_model_latest"
UNKNOWN_MODEL = "UnknownModel"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; of several writers one succeeds.

    File systems promise that for a create that may not overwrite; for local files the
    operating system does.
    """
    target, fs = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            os.close(os.open(target.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError as error:
        if not fs.exists(target):
            raise error
        return False
    return True


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Names under a folder that are whole numbers, in order."""
    target, fs = _file_system(spark, folder)
    if not fs.exists(target):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(target)]
    return sorted(int(n) for n in names if n.isdigit())


def claim_version(spark: SparkSession, folder: str, least: int = 1) -> int:
    """Take the next number of a folder for this writer alone, from ``least`` on.

    A claim is a file that only one writer can create; who comes second takes the next number.
    A writer that fails leaves a gap.
    """
    claims = f"{folder}/claims"
    number = max([least - 1, *_numbers(spark, claims)]) + 1
    while not _create_new(spark, f"{claims}/{number}"):
        number += 1
    return number


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look a path up in whatever file system it names."""
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


# ---- run log ------------------------------------------------------------------------------

def log_run(spark: SparkSession, path: str, experiment: str, run_name: str, params: dict | None = None,
            metrics: dict | None = None, tags: dict | None = None, run_id: str | None = None,
            start_time: datetime | None = None) -> str:
    """Append one run and return its id."""
    run_id = run_id or uuid.uuid4().hex
    row = (run_id, experiment, run_name, start_time or _now(),
           {k: str(v) for k, v in (params or {}).items()},
           {k: float(v) for k, v in (metrics or {}).items() if v is not None},
           {k: str(v) for k, v in (tags or {}).items()})
    append_runs(spark.createDataFrame([row], RUN_SCHEMA), path)
    return run_id


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run rows; the experiment is a partition, so that reads of one prune the others."""
    runs.write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def map_rows(runs: DataFrame, column: str) -> DataFrame:
    """The entries of a run's map column as rows ``(run_id, name, value)``."""
    return runs.select("run_id", F.explode(column).alias("name", "value"))


def successful_runs(runs: DataFrame, experiment: str) -> DataFrame:
    return runs.where((F.col("experiment") == experiment)
                      & (F.try_element_at("tags", F.lit("status")) == "success"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run (a top-k of one, no full sort)."""
    return runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(1)


def latest_run_per(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest run id per key, reduced before the shuffle."""
    return runs.groupBy(*keys).agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"))


def lineage(trainings: DataFrame, preparations: DataFrame, keys: Sequence[str],
            id: str = "run_id", ts: str = "start_time") -> DataFrame:
    """Add ``preprocessing_run_id``: the latest preparation at or before each training run.

    Pass successful preparations only. A run without one keeps a null. Both sides are
    merged in time order, so one pass over a single shuffle answers the as-of join.
    """
    prep = preparations.select(*keys, ts, id).withColumn("_side", F.lit(0))
    train = trainings.withColumn("_side", F.lit(1))
    both = prep.unionByName(train, allowMissingColumns=True)
    folded = running_fold(both, keys, [ts, "_side", id], {
        "preprocessing_run_id": ("last", F.when(F.col("_side") == 0, F.col(id)))})
    return folded.where("_side = 1").select(*trainings.columns, "preprocessing_run_id")


def with_run_details(pointers: DataFrame, runs: DataFrame) -> DataFrame:
    """Add model name and RMSE of the run each pointer names, with defaults where unknown."""
    details = runs.select("run_id", C.map_default("params", "best_model_name", UNKNOWN_MODEL)
                          .alias("algorithm"),
                          C.map_default("metrics", "best_RMSE", 0.0).alias("best_rmse"))
    return (pointers.join(details, "run_id", "left")
            .withColumn("algorithm", F.coalesce("algorithm", F.lit(UNKNOWN_MODEL)))
            .withColumn("best_rmse", F.coalesce("best_rmse", F.lit(0.0))))


# ---- score history --------------------------------------------------------------------------

def score_record(scores: DataFrame, run_timestamp: str | Column, best_model: str | Column,
                 best_run_id: str | Column, best_rmse: float | Column,
                 preprocessing_run_id: str | Column | None = None) -> DataFrame:
    """One nested history record from the rows of a score table (one row per model)."""
    def column(value, kind="string"):
        return value if isinstance(value, Column) else F.lit(value).cast(kind)

    entry = F.struct("model", F.struct(*[F.round(n, 4).alias(n) for n in SCORE_NAMES]))
    return (scores.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("models"))
            .select(column(run_timestamp).alias("run_timestamp"),
                    column(best_model).alias("best_model"),
                    column(best_run_id).alias("best_run_id"),
                    F.round(column(best_rmse, "double"), 4).alias("best_rmse"),
                    column(preprocessing_run_id).alias("preprocessing_run_id"), "models"))


def append_scores(record: DataFrame, path: str) -> None:
    """Append to the JSON history; nothing already written is read or rewritten."""
    record.write.mode("append").json(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORES_SCHEMA).json(path)


def flat_scores(history: DataFrame) -> DataFrame:
    """One row per run and model."""
    return history.select("run_timestamp", "best_run_id", "best_model",
                          F.explode("models").alias("model", "_s")).select(
        "run_timestamp", "best_run_id", "best_model", "model", "_s.*")


def history_length(history: DataFrame) -> DataFrame:
    return history.agg(F.count(F.lit(1)).alias("n_runs"))


# ---- champion pointer -------------------------------------------------------------------------

def write_champion(champion: DataFrame, path: str) -> int:
    """Write the pointer table (one row with ``run_id``) as the next version, and return that.

    Earlier versions stay, so a reader finds a whole pointer at any time, and of two writers
    the one with the higher number stands.
    """
    number = claim_version(champion.sparkSession, path)
    champion.write.parquet(f"{path}/{number}")
    return number


def read_champion(spark: SparkSession, path: str) -> str:
    """The champion's run id; raises when there is no pointer or the pointer is blank."""
    whole = [n for n in _numbers(spark, path) if path_exists(spark, f"{path}/{n}/_SUCCESS")]
    if not whole:
        raise FileNotFoundError(f"no champion pointer at {path}; train first")
    newest = spark.read.parquet(f"{path}/{whole[-1]}")
    row = newest.select(F.trim("run_id", F.lit(" \t\r\n")).alias("run_id")).limit(1).first()
    if row is None or not row["run_id"]:
        raise ValueError(f"the champion pointer at {path} is empty; train again")
    return row["run_id"]


# ---- model store ------------------------------------------------------------------------------

def save_model(model: PipelineModel, path: str) -> None:
    if not isinstance(model, PipelineModel):
        model = PipelineModel(stages=[model])
    model.write().overwrite().save(path)


def log_model(model: PipelineModel, root: str, run_id: str, name: str = "model") -> str:
    """Save a model as an artifact of a run and return its path."""
    path = f"{root}/artifacts/{run_id}/{name}"
    save_model(model, path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """Load a pipeline model after checking that its folder is complete.

    The path of the latest model is a pointer: it leads to the newest version.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no model at {path}")
    if path.rstrip("/").rsplit("/", 1)[-1] == LATEST and (newest := _numbers(spark, path)):
        path = f"{path.rstrip('/').rsplit('/', 1)[0]}/{VERSION_PREFIX}{newest[-1]}"
    missing = [part for part in ("metadata", "stages") if not path_exists(spark, f"{path}/{part}")]
    if missing:
        raise FileNotFoundError(f"model at {path} is incomplete: no {' and no '.join(missing)}")
    return PipelineModel.load(path)


def versions(registry: DataFrame) -> DataFrame:
    """``n_versions`` and ``next_version`` of a registry; gaps never lead to an overwrite."""
    name = F.element_at(F.split("versioned_path", "/"), -1)
    return (registry.where(name.startswith(VERSION_PREFIX))
            .agg(F.count(F.lit(1)).alias("n_versions"),
                 (F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version")))


def versioned_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Entries of the model store that are versions."""
    return names.where(F.col(column).startswith(VERSION_PREFIX))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def promote(spark: SparkSession, model: PipelineModel, store: str, run_id: str, algorithm: str,
            best_rmse: float, model_name: str) -> int:
    """Save a model as the next version, record it, and let ``latest`` point to it.

    Returns the version. It is claimed first, so that two promotions at once get two versions.
    ``latest`` is a folder with an empty file for each version, made once the version is whole:
    nothing is overwritten, and a reader always finds a whole model behind it.
    """
    registry_path = f"{store}/registry"
    least = int(versions(read_registry(spark, registry_path)).first()["next_version"])
    version = claim_version(spark, store, least)
    versioned, latest = f"{store}/{VERSION_PREFIX}{version}", f"{store}/{LATEST}"
    save_model(model, versioned)
    row = (model_name, algorithm, run_id, float(best_rmse), version, versioned, latest, _now())
    # A folder for each version: writers at once do not clear up each other's unfinished files.
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.parquet(f"{registry_path}/{version}")
    _create_new(spark, f"{latest}/{version}")
    return version
