"""A table with one row per key, kept by a stream and rewritten bucket by bucket.

Complete mode writes every key after every batch. Here keys are dealt to a fixed number of
buckets by their hash; a batch rewrites only the buckets that hold one of its keys, as a new
version, and commits by writing a manifest that names each bucket's version. A reader sees the
table as the last manifest has it. A batch that is run again starts from the manifest before
it and replaces its own version.

Layout under a root folder:  rows/N/bucket=B   manifest/N   checkpoint
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskspark.streaming.events import _folder, written_versions

CHANGED = "changed_in"  # the batch that last changed a key's row


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _with_batch(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType) for f in schema]
    return T.StructType([*fields, T.StructField(CHANGED, T.LongType())])


def _manifest(spark: SparkSession, root: str, number: int) -> tuple[int, dict[int, int]]:
    """Number of buckets, and the version of each bucket that holds a key."""
    rows = spark.read.parquet(f"{root}/manifest/{number}").collect()
    return rows[0]["buckets"], {r["bucket"]: r["version"] for r in rows}


def _read(spark: SparkSession, root: str, parts: dict[int, int], schema: T.StructType) -> DataFrame:
    paths = [f"{root}/rows/{version}/bucket={bucket}" for bucket, version in sorted(parts.items())]
    return spark.read.schema(schema).parquet(*paths)


def merge_stream(df: DataFrame, key: str, newest: Callable[[DataFrame], DataFrame], root: str,
                 buckets: int = 256) -> StreamingQuery:
    """Process what is there and stop; a restart goes on from the last manifest.

    ``newest`` maps rows to one row per key, the one to keep; it is applied to a batch together
    with the table's rows in that batch's buckets, so it must not matter whether rows are reduced
    at once or in steps. Choose ``buckets`` so that one holds what a task writes well: a batch that
    touches few keys rewrites at most as many buckets. It is fixed by the first batch; another
    number later is an error. A null key is a key. The table grows with its keys, not its rows.
    """
    schema = _with_batch(df.schema)

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in written_versions(spark, f"{root}/manifest") if v < number]
        parts: dict[int, int] = {}
        if before:
            known, parts = _manifest(spark, root, before[-1])
            if known != buckets:
                raise ValueError(f"{root} has {known} buckets, not {buckets}")
        # One row per key of the batch: read to name the buckets, and again to merge.
        found = newest(batch.withColumn(CHANGED, F.lit(number).cast("long")))
        found = found.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r[0] for r in found.select(_bucket(key, buckets)).distinct().collect()]
            if not touched:
                return
            old = {b: parts[b] for b in touched if b in parts}
            merged = found
            if old:
                merged = newest(found.unionByName(_read(spark, root, old, schema)))
            # Large buckets are split and small ones share a task, as AQE sees their sizes.
            (merged.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", "bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows/{number}"))
        finally:
            found.unpersist()
        now = {**parts, **dict.fromkeys(touched, number)}
        (spark.createDataFrame([(buckets, b, v) for b, v in sorted(now.items())],
                               "buckets int, bucket int, version long")
         .coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/{number}"))
        _forget(spark, root, before, now)

    return (df.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{root}/checkpoint").foreachBatch(process).start())


def _forget(spark: SparkSession, root: str, before: list[int], now: dict[int, int]) -> None:
    """Delete what neither the newest manifest nor the one before it names."""
    if not before:
        return
    kept = {*now.items(), *_manifest(spark, root, before[-1])[1].items()}
    for old in before[:-1]:
        for bucket, version in set(_manifest(spark, root, old)[1].items()) - kept:
            path, fs = _folder(spark, f"{root}/rows/{version}/bucket={bucket}")
            fs.delete(path, True)
        path, fs = _folder(spark, f"{root}/manifest/{old}")
        fs.delete(path, True)


def read_merged(spark: SparkSession, root: str, schema: T.StructType,
                since: int | None = None) -> DataFrame:
    """The table as last committed, with ``changed_in``; empty before the first batch.

    ``schema`` is that of the stream. With ``since``, only rows that changed in that batch or
    later (update mode): buckets untouched since then are not read.
    """
    schema = _with_batch(schema)
    versions = written_versions(spark, f"{root}/manifest")
    parts = _manifest(spark, root, versions[-1])[1] if versions else {}
    if since is not None:
        parts = {b: v for b, v in parts.items() if v >= since}
    if not parts:
        return spark.createDataFrame([], schema)
    rows = _read(spark, root, parts, schema)
    return rows if since is None else rows.where(F.col(CHANGED) >= since)
