"""Train/test split and fold assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskspark.functions import columns as C
from riskspark.spec import JobSpec


def hash_split(df: DataFrame, key: str, spec: JobSpec, out: str = "split") -> DataFrame:
    """Add ``train``/``test`` by key hash: repeatable under any partitioning, no shuffle."""
    return df.withColumn(out, C.split_name(key, spec.test_size, spec.seed))


def bernoulli_split(df: DataFrame, spec: JobSpec) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. It repeats only while the input partitioning stays the same."""
    train, test = df.randomSplit([1.0 - spec.test_size, spec.test_size], seed=spec.seed)
    return train, test


def assign_folds(df: DataFrame, key: str, spec: JobSpec, out: str = "fold") -> DataFrame:
    """Add a cross-validation fold 0..folds-1 by key hash."""
    return df.withColumn(out, C.fold_number(key, spec.folds))
