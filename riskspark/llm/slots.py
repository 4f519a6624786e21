"""Gapless numbers inside groups of any size, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.arrow import free_name, same

#: Rows that one sort of a hot group should hold on average.
ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 64


def bucket_count(rows: int) -> int:
    """Buckets that each group is cut into; grows with the table."""
    return LEAST_BUCKETS + rows // ROWS_PER_BUCKET


def gapless_slots(df: DataFrame, groups: list[str], spread: Column, order: list[str],
                  rows: int, name: str = "slot") -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without sorting a group in one task.

    ``spread`` is a whole number >= 0 that scatters the rows of a group. It deals every group
    into buckets; counts by bucket (summed before the shuffle) give each bucket its first
    number, and only single buckets are sorted. The order is by bucket, then ``order``. Groups
    must not be null. Rows equal in all of ``order`` get different numbers in any order.
    """
    bucket, place, begin, count = (free_name(df, n) for n in ("_bucket", "_place", "_start", "_rows"))
    keyed = df.withColumn(bucket, spread % F.lit(bucket_count(rows)))
    keys = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
              .select(*keys, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(begin)))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (keyed.withColumn(place, F.row_number().over(inside) - 1)
            .join(starts, keys)
            .withColumn(name, (F.col(begin) + F.col(place)).cast("bigint"))
            .drop(bucket, place, begin))


def gapless_slots_by_key(df: DataFrame, groups: list[str], spread: Column, key: str,
                         rows: int, name: str = "slot") -> DataFrame:
    """Number the rows of each group 0, 1, 2, ..., whatever share of all rows one key holds.

    As ``gapless_slots``, for a ``spread`` that follows from ``key``; all columns must be sortable
    and groups not null. The order is by bucket, key, hash part of the other columns, then these
    columns, so a key's rows are cut by their hash into parts which are sorted alone. Equal rows
    are counted before the shuffle and numbered as one; they are told apart again in runs of at
    most ``ROWS_PER_BUCKET``, dealt out among the tasks. Nothing depends on the order of arrival,
    so a lost task is computed again to the same numbers.
    """
    bucket, part, copies, begin, place, run = (free_name(df, n) for n in (
        "_bucket", "_part", "_copies", "_start", "_place", "_run"))
    columns, buckets = df.columns, F.lit(bucket_count(rows))
    rest = [c for c in columns if c not in (key, *groups)]
    zero = F.lit(0).cast("bigint")
    # Columns that cannot be null need no null filters, which would keep Spark from using the
    # merged rows' one exchange for all three steps.
    merged = (df.withColumn(bucket, F.coalesce(spread % buckets, zero))
              .withColumn(part, F.coalesce(F.pmod(F.xxhash64(*rest), buckets), zero) if rest else zero)
              .groupBy(*columns, bucket, part).agg(F.count(F.lit(1)).alias(copies)))
    whole, keys = [*groups, bucket], [*groups, bucket, key, part]

    def sum_before(of: str, within: list[str], order: list[str]) -> Column:
        frame = (Window.partitionBy(*within).orderBy(*order)
                 .rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(F.sum(of).over(frame), F.lit(0))

    counts = merged.groupBy(*keys).agg(F.sum(copies).alias(copies))
    begins = (counts.groupBy(*whole).agg(F.sum(copies).alias(copies))
              .select(*whole, sum_before(copies, groups, [bucket]).alias(begin)))
    starts = (counts.withColumn(place, sum_before(copies, whole, [key, part]))
              .join(begins, whole)
              .select(*[F.col(c).alias(f"{c}{begin}") for c in keys],
                      (F.col(begin) + F.col(place)).alias(begin)))
    match = [same(F.col(c), F.col(f"{c}{begin}")) if c == key else F.col(c) == F.col(f"{c}{begin}")
             for c in keys]
    first = (merged.withColumn(place, sum_before(copies, keys, rest or [key])).join(starts, match)
             .withColumn(begin, F.col(begin) + F.col(place))
             .select(*columns, copies, begin, F.explode(F.sequence(
                 zero, F.floor((F.col(copies) - 1) / ROWS_PER_BUCKET))).alias(run)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low = F.col(run) * ROWS_PER_BUCKET
    high = F.least(F.col(copies), low + ROWS_PER_BUCKET) - 1
    return (first.repartition(tasks, *columns, run)
            .select(*columns, F.explode(F.sequence(F.col(begin) + low, F.col(begin) + high)).alias(name)))
