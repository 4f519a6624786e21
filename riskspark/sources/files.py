"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_source(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Load a dataset of any Spark format; state a schema wherever it is known."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the cost of another pass."""
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    return spark.read.csv(path, header=True, inferSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column, one file per partition."""
    df.write.mode("overwrite").csv(path, header=True)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_prepared(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, replacing what is there; ``partition_by=["split"]`` lets readers prune."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
