"""Profiling: shape, nulls, duplicates, first rows, split sizes, moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.session import shared_dir
from pyspark.sql import types as T


def shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, ``n_columns``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def _missing(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls (and NaNs) per column, all columns in one pass, one column each."""
    return df.agg(*[F.count_if(_missing(f)).alias(f.name) for f in df.schema.fields])


def null_counts_long(df: DataFrame) -> DataFrame:
    """The same as rows ``(column_name, nulls)``."""
    return null_counts(df).unpivot([], df.columns, "column_name", "nulls")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: ``duplicates``, the rows beyond the first copy of each distinct row.

    Rows are counted by 128-bit digests, merged before the shuffle, so digests travel and not
    rows. Only rows whose digest another row has are compared in full.
    """
    shared_dir(df.sparkSession)
    columns = [F.col(f"`{c}`") for c in df.columns]
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *reversed(columns))
    met = (df.select(first.alias("_d1"), second.alias("_d2")).groupBy("_d1", "_d2")
           .agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_d1", "_d2").checkpoint())
    again = df.join(met, (first == F.col("_d1")) & (second == F.col("_d2")), "left_semi")
    return (again.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("extra"))
            .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates")))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split, in one job."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))


def moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row with ``<f>_mean`` and ``<f>_std`` (sample, n-1) per feature."""
    return df.agg(*[a for f in features for a in (
        F.avg(f).alias(f"{f}_mean"), F.stddev_samp(f).alias(f"{f}_std"))])
