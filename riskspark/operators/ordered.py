"""Ordered per-key logic that survives a key holding a third of all rows.

A plain window sends every row of a key to one task. Here the keys with more rows than a slice
should hold are cut into slices along their order, so a hot key spreads over many of them; all
other keys share the remaining slices by their hash. Each slice is numbered or folded on its
own, and what a hot key brings along from its earlier slices is added afterwards. There are no
more slices of hot keys than about twice the slices asked for, so that carried table is safe to
broadcast.

Where a hot key is cut is decided once, from a sample of its positions that is picked by hash,
and stands in the plan as literals: nothing is written, the plan stays lazy, and slices are the
same however often a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

SLICE = "_slice"
#: Number of a row's hot key, null for other keys; the slices of a hot key follow each other.
HOT = "_hot"
# A slice is handled by one task: aim at this many bytes of input each.
SLICE_BYTES = 256 * 2**20
UNKNOWN_BYTES = 2**62
# Sampled positions for each slice of a hot key, and cuts that are searched together.
SAMPLES = 64
CHUNK = 256


def _bytes_read(df: DataFrame) -> int:
    """Size of what a plan reads: the sum over its sources, as Spark knows them.

    The estimate of a whole plan multiplies the sides of a join and is useless here. If the
    size of a source is not known, the rows are counted instead, at the width of their types.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    if all(s < UNKNOWN_BYTES for s in sizes):
        return sum(sizes)
    return df.count() * int(df._jdf.schema().defaultSize())


def slice_count(df: DataFrame) -> int:
    """One slice for each ``SLICE_BYTES`` of input, at least the shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-_bytes_read(df) // SLICE_BYTES))


def _position(df: DataFrame, order: Sequence[str]) -> Column:
    """The order columns as one value; times as numbers, so that they travel unchanged."""
    return F.struct(*[(F.unix_micros(c) if isinstance(df.schema[c].dataType, TimestampType)
                       else F.col(c)).alias(f"_{i}") for i, c in enumerate(order)])


def _same_keys(df: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for i, c in enumerate(keys):
        condition = condition & F.col(c).eqNullSafe(F.col(f"_h_{i}"))
    return condition


@dataclass(frozen=True)
class Slices:
    """Where the hot keys of a table are cut: ``cuts`` is a local table with a row for each."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    slices: int
    cuts: DataFrame | None
    longest: int = 1  # most slices of a key

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` with ``SLICE`` and ``HOT``."""
        shared = F.pmod(F.xxhash64(*self.keys) if self.keys else F.lit(0), F.lit(self.slices)).cast("int")
        if self.cuts is None:
            return df.withColumn(SLICE, shared).withColumn(HOT, F.lit(None).cast("int"))
        joined = df.join(F.broadcast(self.cuts), _same_keys(df, self.keys), "left")
        here = _position(df, self.order)
        chunk = F.size(F.filter("_chunks", lambda c: c["head"] <= here))
        inside = F.size(F.filter(F.element_at("_chunks", F.greatest(chunk, F.lit(1)))["cuts"],
                                 lambda c: c <= here))
        place = F.when(chunk == 0, 0).otherwise((chunk - 1) * CHUNK + inside)
        return (joined.withColumn(SLICE, F.when(F.col(HOT).isNull(), shared)
                                  .otherwise(F.col("_first") + place).cast("int"))
                .drop("_chunks", "_first", *[f"_h_{i}" for i in range(len(self.keys))]))


def cut_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               slices: int | None = None) -> Slices:
    """Find the hot keys of ``df`` and cut them.

    ``order`` must end in a unique column, so that no group of equal rows is unbounded.
    ``slices`` says how many; without it, ``slice_count`` does. Two jobs read the key and the
    order columns; the second one runs only if there is a hot key.
    """
    spark, slices = df.sparkSession, slices or slice_count(df)
    per_slice = max(1, -(-df.count() // slices))
    named = [F.col(c).alias(f"_h_{i}") for i, c in enumerate(keys)]
    names = [f"_h_{i}" for i in range(len(keys))]
    hot = (df.groupBy(*named).agg(F.count(F.lit(1)).alias("_rows"))
           .where(F.col("_rows") > per_slice)).toArrow()  # fewer rows than slices
    if not hot.num_rows:
        return Slices(tuple(keys), tuple(order), slices, None)
    local = spark.createDataFrame(hot).drop("_rows")
    within = df.select(*named, _position(df, order).alias("_at"))
    sampled = within.where(F.pmod(F.xxhash64("_at"), F.lit(per_slice)) < SAMPLES)
    if keys:
        same = F.lit(True)
        for n in names:
            same = same & sampled[n].eqNullSafe(local[n])
        sampled = sampled.join(F.broadcast(local), same, "left_semi")
    line = Window.partitionBy(*names).orderBy("_at")
    each = min(SAMPLES, per_slice)
    cuts = (sampled.withColumn("_turn", F.row_number().over(line))
            .where(F.col("_turn") % each == 0)
            .withColumn("_chunk", F.floor((F.col("_turn") / each - 1) / CHUNK))
            .groupBy(*names, "_chunk").agg(F.sort_array(F.collect_list("_at")).alias("cuts"))
            .groupBy(*names).agg(
                F.sort_array(F.collect_list(F.struct(F.col("cuts")[0].alias("head"), "cuts")))
                .alias("_chunks"),
                (F.sum(F.size("cuts")) + 1).cast("int").alias("_parts"))).toArrow()
    if not cuts.num_rows:
        return Slices(tuple(keys), tuple(order), slices, None)
    parts = cuts.column("_parts").to_pylist()
    first = [slices + sum(parts[:i]) for i in range(len(parts))]
    table = (cuts.drop_columns("_parts").append_column(HOT, pa.array(range(len(parts)), pa.int32()))
             .append_column("_first", pa.array(first, pa.int32())))
    return Slices(tuple(keys), tuple(order), slices, spark.createDataFrame(table), max(parts))


def slice_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   slices: int | None = None) -> DataFrame:
    """Add the number of the slice a row falls into; see ``cut_slices``."""
    return cut_slices(df, keys, order, slices).add(df).drop(HOT)


def join_carry(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a carried table on slice and (null-safe) key.

    Only slices of hot keys are carried into, so the table is small.
    """
    names = (SLICE, *keys)
    renamed = carry.select(*[F.col(c).alias(f"_c_{c}") for c in names],
                           *[c for c in carry.columns if c not in names])
    condition = F.lit(True)
    for c in names:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    return df.join(F.broadcast(renamed), condition, "left").drop(*[f"_c_{c}" for c in names])


def _earlier_slices(keys: Sequence[str]):
    return (Window.partitionBy(*keys).orderBy(SLICE)
            .rowsBetween(Window.unboundedPreceding, -1))


def running_number(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   out: str = "number", slices: int | None = None,
                   earlier: DataFrame | None = None) -> DataFrame:
    """``row_number`` of each row within its key, counted from 1 in ``order``.

    ``earlier`` holds ``(keys, rows)``: how many rows of a key came before this table. They
    take part as one row in front of the key's others, which counts for so many.
    """
    cut = cut_slices(df, keys, order, slices)
    rows = df.withColumn("_weight", F.lit(1).cast("bigint"))
    first: list[Column] = []
    if earlier is not None:
        marker = earlier.select(*keys, F.col("rows").cast("bigint").alias("_weight"),
                                F.lit(0).alias("_side"))
        rows = rows.withColumn("_side", F.lit(1)).unionByName(marker, allowMissingColumns=True)
        first = [F.col("_side")]
    sliced = cut.add(rows)
    line = (Window.partitionBy(SLICE, *keys).orderBy(*first, *order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = sliced.withColumn(out, F.sum("_weight").over(line))
    if cut.cuts is not None:
        sizes = (sliced.where(F.col(HOT).isNotNull()).groupBy(SLICE, *keys)
                 .agg(F.sum("_weight").alias("_rows")))
        carry = (sizes.withColumn("_before", F.sum("_rows").over(_earlier_slices(keys)))
                 .where("_before > 0").drop("_rows"))
        numbered = (join_carry(numbered, carry, keys)
                    .withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_before"))
    if first:
        numbered = numbered.where("_side = 1").drop("_side")
    return numbered.drop(SLICE, HOT, "_weight")


_COMBINE = {
    "last": lambda local, carried: F.coalesce(local, carried),
    "min": lambda local, carried: F.least(local, carried),
    "max": lambda local, carried: F.greatest(local, carried),
}


def running_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 folds: dict[str, tuple[str, Column]], include_current: bool = True,
                 slices: int | None = None) -> DataFrame:
    """Running ``last`` (non-null), ``min`` or ``max`` of values within a key.

    ``folds`` maps an output name to (kind, value). Without the current row a fold
    covers the rows strictly before it.
    """
    end = Window.currentRow if include_current else -1
    rows = (Window.partitionBy(SLICE, *keys).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, end))
    earlier = _earlier_slices(keys)
    position = F.struct(*order)

    inputs = {out: f"_v_{out}" for out in folds}
    cut = cut_slices(df, keys, order, slices)
    sliced = cut.add(df.select("*", *[value.alias(inputs[out]) for out, (_, value) in folds.items()]))

    per_slice, carried, local = [], [], sliced
    for out, (kind, _) in folds.items():
        value = F.col(inputs[out])
        if kind == "last":
            per_slice.append(F.max_by(value, F.when(value.isNotNull(), position)).alias(out))
            carried.append(F.last(out, ignorenulls=True).over(earlier).alias(f"_k_{out}"))
            local = local.withColumn(out, F.last(value, ignorenulls=True).over(rows))
        else:
            fold = {"min": F.min, "max": F.max}[kind]
            per_slice.append(fold(value).alias(out))
            carried.append(fold(out).over(earlier).alias(f"_k_{out}"))
            local = local.withColumn(out, fold(value).over(rows))
    if cut.cuts is None:
        return local.drop(SLICE, HOT, *inputs.values())

    names = [f"_k_{out}" for out in folds]
    carry = (sliced.where(F.col(HOT).isNotNull()).groupBy(SLICE, *keys).agg(*per_slice)
             .select(SLICE, *keys, *carried)
             .where(" or ".join(f"{n} is not null" for n in names)))
    result = join_carry(local, carry, keys)
    for out, (kind, _) in folds.items():
        result = result.withColumn(out, _COMBINE[kind](F.col(out), F.col(f"_k_{out}")))
    return result.drop(SLICE, HOT, *inputs.values(), *names)
