"""Sliced operators equal plain windows, above all when one key holds most of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators.ordered import (SLICE, running_fold, running_number, slice_by_order,
                                         slice_count)


def hot_rows(seed, n=400):
    """One key with more than a third of the rows, a null key, equal times, some null values."""
    r = random.Random(seed)
    return [(r.choice(["hot"] * 6 + ["a", "b", None]), r.randrange(60), i,
             None if r.random() < 0.6 else r.random()) for i in range(n)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(hot_rows(1), "k string, t int, id int, v double").repartition(3)


@pytest.mark.parametrize("slices", [1, 2, 7])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_number(df, keys, slices):
    expected = df.withColumn("e", F.row_number().over(Window.partitionBy(*keys).orderBy("t", "id")))
    got = running_number(df, keys, ["t", "id"], "n", slices).select("id", "n")
    assert got.join(expected, "id").where("n != e").count() == 0
    assert got.count() == df.count()


@pytest.mark.parametrize("slices", [1, 7])
@pytest.mark.parametrize("current", [True, False])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_fold(df, keys, current, slices):
    w = (Window.partitionBy(*keys).orderBy("t", "id")
         .rowsBetween(Window.unboundedPreceding, 0 if current else -1))
    expected = df.select("id", F.last("v", True).over(w).alias("e_last"),
                         F.min("v").over(w).alias("e_min"), F.max("v").over(w).alias("e_max"))
    got = running_fold(df, keys, ["t", "id"], {
        "g_last": ("last", F.col("v")), "g_min": ("min", F.col("v")), "g_max": ("max", F.col("v"))},
        current, slices)
    both = got.join(expected, "id")
    assert both.count() == df.count()
    for kind in ("last", "min", "max"):
        assert both.where(f"not (g_{kind} <=> e_{kind})").count() == 0


def test_hot_key_is_spread(df):
    parts = slice_by_order(df, ["k"], ["t", "id"], 8).groupBy(SLICE).count().collect()
    assert max(r["count"] for r in parts) < 0.3 * df.count()


def test_carried_rows_are_fewer_than_slices(df):
    sliced = slice_by_order(df, ["k"], ["t", "id"], 8)
    groups = sliced.groupBy("k").agg(F.countDistinct(SLICE).alias("n"))
    assert groups.agg(F.sum(F.col("n") - 1)).first()[0] < 8


def test_empty(spark):
    empty = spark.createDataFrame([], "k string, t int, id int, v double")
    assert running_number(empty, ["k"], ["t", "id"]).count() == 0


def test_slices_grow_with_the_input(spark):
    small, large = spark.range(1000), spark.range(10**10)
    assert slice_count(small) == 4
    assert 250 < slice_count(large) < 350  # 8 bytes a row, 256 MiB a slice
    assert slice_count(spark.range(10**15)) == -(-8 * 10**15 // (256 * 2**20))


def test_input_of_unknown_size_is_counted(spark, monkeypatch):
    import riskspark.operators.ordered as ordered

    rows = spark.createDataFrame([(i,) for i in range(1000)], "id bigint")
    monkeypatch.setattr(ordered, "SLICE_BYTES", 80)
    assert slice_count(rows) == 100


def test_slices_of_a_chain_of_operators(df):
    """Neither a join of carried rows nor a checkpoint inflates the estimate."""
    once = running_number(df, ["k"], ["t", "id"], "n")
    assert slice_count(once) == 4
    assert slice_count(running_number(once, ["k"], ["t", "id"], "m")) == 4


def test_earlier_rows_are_counted_in(spark, df):
    earlier = spark.createDataFrame([("hot", 7), (None, 2), ("gone", 5)], "k string, rows bigint")
    plain = running_number(df, ["k"], ["t", "id"], "n", 5).select("id", "n")
    shifted = running_number(df, ["k"], ["t", "id"], "m", 5, earlier).select("id", "k", "m")
    added = F.when(F.col("k") == "hot", 7).when(F.col("k").isNull(), 2).otherwise(0)
    assert shifted.join(plain, "id").where(F.col("m") != F.col("n") + added).count() == 0
    assert shifted.count() == df.count()


def test_slices_are_literals_and_nothing_is_written(spark, df):
    """Neither a work table nor a copy of the rows: the plan reads its input, cuts are local rows."""
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    numbered = running_number(df, ["k"], ["t", "id"], "n", 6)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan or "LogicalRDD" in plan
    assert "parquet" not in plan.lower()
    assert (sorted(os.listdir(folder)) if os.path.isdir(folder) else []) == before


def test_without_a_hot_key_it_is_a_plain_window(spark):
    even = spark.range(1000).selectExpr("id % 100 as k", "id")
    plan = running_number(even, ["k"], ["id"], "n", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and "Join" not in plan


@pytest.mark.parametrize("slices", [3, 40, 400])
def test_slices_follow_the_order_of_their_key(spark, df, slices):
    rows = slice_by_order(df, ["k"], ["t", "id"], slices).collect()
    for key in ("hot", "a", "b", None):
        own = sorted((r.t, r.id, r[SLICE]) for r in rows if r.k == key)
        assert [s for _, _, s in own] == sorted(s for _, _, s in own)
    by_slice = {}
    for r in rows:
        by_slice.setdefault(r[SLICE], set()).add(r.k)
    hot = {r[SLICE] for r in rows if r.k == "hot"}
    assert len(hot) > slices // 4
    assert all(by_slice[s] == {"hot"} for s in hot)


def test_more_cuts_than_a_chunk_holds(spark, monkeypatch):
    import riskspark.operators.ordered as ordered

    monkeypatch.setattr(ordered, "CHUNK", 4)
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "id div 7 t", "id")
    w = Window.partitionBy("k").orderBy("t", "id")
    for slices in (30, 700):
        got = running_number(rows, ["k"], ["t", "id"], "n", slices)
        assert got.join(rows.withColumn("e", F.row_number().over(w)), "id").where("n != e").count() == 0


def test_order_by_times_and_texts(spark):
    rows = (spark.range(900).selectExpr("'k' k", "timestamp_seconds(id div 5) t",
                                        "if(id % 9 = 0, null, cast(id as string)) s", "id"))
    w = Window.partitionBy("k").orderBy("t", "s", "id")
    got = running_number(rows, ["k"], ["t", "s", "id"], "n", 12)
    assert got.join(rows.withColumn("e", F.row_number().over(w)), "id").where("n != e").count() == 0
