"""Serving rules against brute force."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import serving

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(k, at(s), i) for i, (k, s) in enumerate(rows)],
                                 "k string, ts timestamp, id int")


def brute_reuse(rows, ttl):
    """(id -> (computed second, hit)), one request after the other."""
    last, result = {}, {}
    for i, (k, s) in sorted(enumerate(rows), key=lambda e: (e[1][1], e[0])):
        if k in last and s - last[k] < ttl:
            result[i] = (last[k], True)
        else:
            last[k] = s
            result[i] = (s, False)
    return result


def run_reuse(spark, rows, ttl, slices):
    out = serving.reuse_results(frame(spark, rows), "k", "ts", "id", ttl, slices).collect()
    base = int(START.timestamp())
    return {r["id"]: (r["computed_us"] / 1e6 - base, r["hit"]) for r in out}


def test_hits_do_not_extend_the_result(spark):
    rows = [("x", s) for s in (0, 59, 60, 100, 121)]
    assert run_reuse(spark, rows, 60, 2) == {0: (0, False), 1: (0, True), 2: (60, False),
                                             3: (60, True), 4: (121, False)}


def pattern(name):
    r = random.Random(name)
    if name == "dense":        # many requests within one ttl, hot key
        return [(r.choice(["hot", "hot", "cold", None]), r.randrange(200)) for _ in range(500)]
    if name == "periodic":     # chains that never meet
        return [("hot", 25 * i) for i in range(300)] + [("cold", 7 * i) for i in range(20)]
    if name == "sparse":
        return [(r.choice("abc"), r.randrange(100_000)) for _ in range(200)]
    if name == "instant":      # everything at one moment
        return [("hot", 5)] * 100
    return [(r.choice(["hot", "hot", "b"]), r.randrange(3000)) for _ in range(400)]


@pytest.mark.parametrize("slices", [1, 3, 9])
@pytest.mark.parametrize("name", ["dense", "periodic", "sparse", "instant", "mixed"])
def test_reuse_equals_brute_force(spark, name, slices):
    rows = pattern(name)
    assert run_reuse(spark, rows, 60, slices) == brute_reuse(rows, 60)


@pytest.mark.parametrize("slices", [1, 4])
def test_reuse_of_nullable_long_keys(spark, slices):
    """Keys beyond the whole numbers of a double, next to null keys and null times."""
    keys = [2 ** 60 + 1, 2 ** 60 + 2, None]
    rows = [(keys[i % 3], at(7 * i), i) for i in range(60)]
    df = spark.createDataFrame([*rows, (keys[0], None, 99)], "k bigint, ts timestamp, id int")
    got = {r["id"]: (r["computed_us"], r["hit"]) for r in
           serving.reuse_results(df, "k", "ts", "id", 60, slices).collect()}
    assert got.pop(99) == (None, False)
    last = {}
    for k, t, i in rows:
        us = int(t.timestamp() * 1_000_000)
        hit = k in last and us < last[k] + 60_000_000
        if not hit:
            last[k] = us
        assert got.pop(i) == (last[k], hit)
    assert not got


def test_rate_limit(spark):
    rows = [("x", s) for s in range(11)] + [("x", 61)]
    out = serving.rate_limit(frame(spark, rows), "k", "ts", "id").orderBy("id").collect()
    assert [r["allowed"] for r in out] == [True] * 10 + [False, True]
    assert out[10]["retry_after"] == 50 and out[11]["retry_after"] == 0


def test_cooldown_ends_with_an_admitted_request(spark):
    rows = [(at(0), 1, False), (at(20), 2, True), (at(30), 3, True)]
    df = spark.createDataFrame([("x", *r) for r in rows], "k string, ts timestamp, id int, allowed boolean")
    out = serving.cooldown(df, "k", "ts", "id").orderBy("id").collect()
    assert [r["wait"] for r in out] == [0, 40, 0]


def test_recent_history_keeps_null_clients(spark):
    rows = [(None, s) for s in range(8)] + [("a", 1)]
    out = serving.recent_history(frame(spark, rows), "k", "ts", "id").collect()
    assert sorted(r["number"] for r in out if r["k"] is None) == [4, 5, 6, 7, 8]
    assert [r["number"] for r in out if r["k"] == "a"] == [1]


def test_recent_history_limits_before_the_shuffle(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = serving.recent_history(events, "user_id", "ts", "event_id")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_latest_result(spark):
    out = serving.latest_result(frame(spark, [("a", 1), ("a", 5), ("a", 5), ("b", 0)]), "k", "ts", "id")
    assert {r["k"]: r["id"] for r in out.collect()} == {"a": 2, "b": 3}


def test_cache_lookup_splits_whole(spark):
    asked = frame(spark, [("a", 1), ("b", 2), ("a", 3)])
    hits, misses = serving.cache_lookup(asked, asked.where(F.col("k") == "a"), "k")
    assert (hits.count(), misses.count()) == (2, 1)


def chain(times, ttl, before=None):
    """Times that compute, one request after the other."""
    out = []
    for t in sorted(times):
        if before is None or t >= before + ttl:
            before = t
            out.append(t)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_composed_leave_maps_equal_the_chain(seed):

    import pandas as pd

    from riskspark.operators.serving import HOT, _compose_maps, _leave_map, _left_by

    r, ttl = random.Random(seed), 50
    for _ in range(60):
        times = sorted(r.randrange(400) for _ in range(r.randint(2, 80)))
        parts = r.randint(1, 9)
        cuts = sorted(r.randrange(len(times) + 1) for _ in range(parts - 1))
        slices = [times[a:b] for a, b in zip([0, *cuts], [*cuts, len(times)], strict=True)]
        maps = [_leave_map(ttl)(pd.DataFrame({HOT: 0, "place": i, "_us": s}))
                for i, s in enumerate(slices) if s]
        while len(maps) > 1:
            pairs = {}
            for m in maps:
                pairs.setdefault(int(m["place"].iloc[0]) // 2, []).append(m)
            maps = [_compose_maps(ttl)(pd.concat(p, ignore_index=True)) for p in pairs.values()]
        whole = maps[0].iloc[0]
        assert whole["leaves"][0] == chain(times, ttl)[-1]
        assert len(whole["upto"]) <= len({t for t in times if t < times[0] + ttl}) + 1
        for e in range(times[0] - 2 * ttl, times[0] + 1):
            got = int(_left_by(ttl, np.array([e]), whole["last_us"], whole["upto"], whole["leaves"])[0])
            assert got == ([e] + chain(times, ttl, e))[-1], (times, cuts, e)


@pytest.mark.parametrize("slices", [2, 9, 60])
def test_a_hot_key_with_slices_shorter_than_the_reuse_period(spark, slices):
    r = random.Random(slices)
    rows = [("hot" if r.random() < 0.8 else r.choice(["a", None]), r.randrange(4000), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, s int, id int").selectExpr(
        "k", "timestamp_seconds(s) ts", "id")
    got = {x.id: (x.computed_us, x.hit) for x in
           serving.reuse_results(df, "k", "ts", "id", 700, slices).select("id", "computed_us", "hit").collect()}
    for key in ("hot", "a", None):
        own = sorted((s, i) for k, s, i in rows if k == key)
        last = None
        for s, i in own:
            hit = last is not None and s < last + 700
            last = last if hit else s
            assert got[i] == (last * 1_000_000, hit)
