"""What-if rows: presets, random scenarios, overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.spec import JobSpec


def expand_scenarios(df: DataFrame, ids: Sequence[str], spec: JobSpec) -> DataFrame:
    """One row per id and scenario: the base features with the scenario's overrides.

    The scenarios are literals of the plan, so each row expands in place without a join.
    """
    if not spec.scenarios:
        raise ValueError("the job declares no scenarios")
    rows = [
        F.struct(F.lit(name).alias("scenario"), *[
            (F.lit(float(overrides[f])) if f in overrides
             else F.col(f).cast("double")).alias(f) for f in spec.features])
        for name, overrides in spec.scenarios.items()]
    return df.select(*ids, F.inline(F.array(*rows)))


def override_map(df: DataFrame, base: str, overrides: str, out: str = "merged") -> DataFrame:
    """Merge two map columns; an override replaces the base entry of the same key."""
    return df.withColumn(out, C.merge_maps(base, overrides))


def random_scenario(df: DataFrame, key: str, features: Sequence[str], low: int = 1,
                    high: int = 10) -> DataFrame:
    """Repeatable pseudo-random integers ``low..high`` per row and feature, from the key's hash.

    A hash gives a number of 60 bits; its digits in base ``high - low + 1`` serve up to
    ``per_hash`` features, so that few hashes are needed per row.
    """
    span = high - low + 1
    # Leave the top digits unused: they are not evenly distributed.
    per_hash = next(k for k in range(60, 0, -1) if span ** (k + 3) <= 2**60)
    blocks = range((len(features) + per_hash - 1) // per_hash)
    hashed = df.withColumns({
        f"_hash_{b}": F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(b)), key)), 1, 15), 16, 10)
        .cast("bigint") for b in blocks})
    return hashed.withColumns({
        f: F.expr(f"cast(_hash_{i // per_hash} div {span ** (i % per_hash)} % {span} + {low} as int)")
        for i, f in enumerate(features)}).drop(*[f"_hash_{b}" for b in blocks])


def random_scenario_seeded(df: DataFrame, features: Sequence[str], seed: int, low: int = 1,
                           high: int = 10) -> DataFrame:
    """The same with Spark's generator; repeats only under an unchanged partitioning."""
    return df.withColumns({
        f: (F.floor(F.rand(seed + i) * (high - low + 1)) + low).cast("int")
        for i, f in enumerate(features)})
