"""Sharding by jump consistent hashing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.arrow import rows_of
from riskspark.llm.slots import gapless_slots_by_key

# The linear congruential step of the published jump hash.
MULTIPLIER = 2862933555777941757
LOW32 = 0xFFFFFFFF


def _key_text(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def _bits(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 8), 16, 10).cast("bigint")


def key_spread(key: Column) -> Column:
    """A whole number below 2^32 from hash bits that do not choose the shard."""
    return _bits(_key_text(key), 17)


def jump_shards(key: Column, shards: int) -> Column:
    """Struct ``(shard, grown)``: the key's shard of ``shards``, and of one shard more.

    The 64-bit state is kept as two 32-bit halves in longs, since a plain product would
    overflow: the multiplier's low half is taken 16 bits at a time.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    low, high = MULTIPLIER & LOW32, MULTIPLIER >> 32
    low0, low1 = low & 0xFFFF, low >> 16
    digest = _key_text(key)

    def step(state: Column, _: Column) -> Column:
        upper, lower, jump = state["hi"], state["lo"], state["jump"]
        cross = lower * F.lit(low1)
        first = (lower * F.lit(low0) + F.shiftleft(cross.bitwiseAND(F.lit(LOW32)), 16) + F.lit(1))
        high_low = (upper * F.lit(low0)
                    + F.shiftleft((upper * F.lit(low1)).bitwiseAND(F.lit(0xFFFF)), 16))
        new_upper = (F.shiftright(first, 32) + F.shiftleft(F.shiftright(cross, 32), 16)
                     + high_low.bitwiseAND(F.lit(LOW32))
                     + (lower * F.lit(high)).bitwiseAND(F.lit(LOW32))).bitwiseAND(F.lit(LOW32))
        live = jump <= F.lit(shards)
        far = F.floor((jump + 1).cast("double") * (F.lit(float(1 << 31))
                      / (F.shiftright(new_upper, 1) + 1).cast("double"))).cast("bigint")
        return F.struct(
            new_upper.alias("hi"), first.bitwiseAND(F.lit(LOW32)).alias("lo"),
            F.when(live, far).otherwise(jump).alias("jump"),
            F.when(jump < F.lit(shards), jump).otherwise(state["shard"]).alias("shard"),
            F.when(live, jump).otherwise(state["grown"]).alias("grown"))

    zero = F.lit(0).cast("bigint")
    start = F.struct(_bits(digest, 1).alias("hi"), _bits(digest, 9).alias("lo"),
                     zero.alias("jump"), zero.alias("shard"), zero.alias("grown"))
    # A jump goes on by one shard at least, so shards + 1 steps always reach the end.
    end = F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step)
    return F.transform(F.array(end), lambda s: F.struct(
        s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))[0]


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                  overhead: int = 8) -> DataFrame:
    """Put every row into a shard that its key and the shard count alone decide.

    Returns the key, ``size`` (UTF-8 bytes plus ``overhead``), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (0, 1, ... in each shard) and ``grown_shard``: the shard once one more
    is appended, which is either the same or the new one. No other column is read.

    A null text counts as empty (crc 0); a null key is hashed as the empty string; rows with
    equal keys share a shard and get slots of their own, however many they are; an empty table gives no row; columns
    of the input that bear a result's name are not looked at.
    """
    jumps = jump_shards(F.col(key), shards)
    chosen = docs.select(F.col(key), F.col(text).alias("_text")).withColumn("_jumps", jumps)
    sized = chosen.select(
        key,
        (F.coalesce(F.octet_length("_text"), F.lit(0)) + overhead).cast("bigint").alias("size"),
        F.crc32(F.coalesce("_text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce("_jumps.shard", F.lit(0)).alias("shard"), F.col("_jumps.grown").alias("grown_shard"))
    numbered = gapless_slots_by_key(sized, ["shard"], key_spread(F.col(key)), key, rows_of(docs))
    return numbered.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                           "grown_shard")
