"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "riskspark", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on.

    Shuffle partitions are left to the cluster; AQE coalesces and splits them.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for checkpoints and work tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session may fall back on a temporary folder: on a cluster a machine-local
    path would be lost together with its executor.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="riskspark-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written work table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/work/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete the work tables of this session's shared folder once nothing reads them any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/work")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def delete_work(spark: SparkSession, path: str) -> None:
    """Delete one work table."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
