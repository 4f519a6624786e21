"""Wide/long reshaping and bag unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per id and feature: ``(ids..., pos, feature, value)``, without a shuffle."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"),
                 F.col(f).cast("double").alias("value"))
        for i, f in enumerate(features)])
    return df.select(*ids, F.inline(entries))


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str,
            names: Sequence[str]) -> DataFrame:
    """One column per given name. Stating the names spares a pass that would look for them."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def append_rows(*tables: DataFrame) -> DataFrame:
    """Bag union by name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def named_values(df: DataFrame, names: Sequence[str], values: str, out: str) -> DataFrame:
    """Map column from fixed names and an array of values."""
    return df.withColumn(out, F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col(values)))
