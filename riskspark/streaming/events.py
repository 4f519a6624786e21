"""Reading and draining request streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

WATERMARK = "10 minutes"


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files: int = 100, **options) -> DataFrame:
    """A folder of files as a stream; ``max_files`` bounds a micro-batch."""
    return (spark.readStream.format(fmt).schema(schema).options(**options)
            .option("maxFilesPerTrigger", max_files).load(path))


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Watermarked event time; a timestamp without zone is read in the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Process what is there and stop; a restart goes on from the checkpoint.

    ``append`` adds Parquet files exactly once. ``complete`` writes the table anew after each
    batch, as a version beside the earlier one: ``read_complete`` always finds a whole table.
    """
    writer = (df.writeStream.outputMode(mode).trigger(availableNow=True)
              .option("checkpointLocation", checkpoint))
    if mode == "append":
        return writer.format("parquet").partitionBy(*partition_by).start(path)

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number}")
        for old in [v for v in written_versions(batch.sparkSession, path) if v < number - 1]:
            target, fs = _folder(batch.sparkSession, f"{path}/{old}")
            fs.delete(target, True)

    return writer.foreachBatch(replace).start()


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def written_versions(spark: SparkSession, path: str, part: str = "") -> list[int]:
    """Versions under a folder whose (part's) write has been committed, in order."""
    target, fs = _folder(spark, path)
    if not fs.exists(target):
        return []
    names = [int(entry.getPath().getName()) for entry in fs.listStatus(target)]
    return sorted(n for n in names if fs.exists(_folder(spark, f"{path}/{n}/{part}/_SUCCESS")[0]))


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole table that a ``complete`` stream has written."""
    return spark.read.parquet(f"{path}/{written_versions(spark, path)[-1]}")
