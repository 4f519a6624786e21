import hashlib
import math
import random

import numpy as np
import pytest

from riskspark.llm.centroids import centroid_clusters, moved, product

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, v int"


def brute(rows, clusters=16, rounds=3, width=64):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == width
          and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in ok)
    centroids = [v for _, v in start[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k)
                    for k, c in enumerate(centroids)) for _, v in ok]

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(ok, found, strict=True) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    total = {k: sum(d for d, c in found if c == k) for k in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, total[k], sum(total.values()), digest[k])
                   for (i, _), (d, k) in zip(ok, found, strict=True)), key=str)


def check(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA).repartition(parts)
    got = sorted((tuple(r) for r in centroid_clusters(df, **how).collect()), key=str)
    shown = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v])
             for i, v in rows]
    assert got == brute(shown, how.get("clusters", 16), how.get("rounds", 3), how.get("width", 64))
    return got


def vectors(seed, count, width, spread=1.0):
    pick = random.Random(seed)
    return [(i, [pick.gauss(i % 5, spread) for _ in range(width)]) for i in range(count)]


def test_given_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = sorted((tuple(r) for r in centroid_clusters(df).collect()), key=str)
    assert got == brute([(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_against_brute_force(spark, rounds):
    check(spark, vectors(1, 90, 6), clusters=5, rounds=rounds, width=6)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(2, 20, 4) + [(30, None), (31, []), (32, [1.0, None, 1.0, 1.0]), (33, [nan] * 4),
                                (34, [1.0, inf, 0.0, 0.0]), (35, [1.0] * 3), (36, [1.0] * 5),
                                (None, [0.5, -0.25, 0.0, 1.0]), (None, [0.5, -0.25, 0.0, 1.0]),
                                (3, [9.0] * 4), (3, [9.0] * 4), (40, [-0.0] * 4)]
    assert len(check(spark, rows, clusters=4, width=4)) == 20 + 5


def test_ties_and_empty_centroids(spark):
    rows = [(i, [float(i % 2)] * 3) for i in range(40)]  # more centroids than distinct vectors
    got = check(spark, rows, clusters=6, width=3)
    assert len({k for _, k, *_ in got}) == 2


def test_fewer_vectors_than_centroids_and_none(spark):
    assert len(check(spark, vectors(4, 3, 4), width=4)) == 3
    assert check(spark, [(1, None)], width=4) == []
    assert check(spark, [], width=4) == []


def test_large_components(spark):
    check(spark, [(i, [2.0 ** 20 * (i % 3 - 1), 1.0 * i]) for i in range(30)], clusters=3, width=2)
    with pytest.raises(Exception, match="64 bits"):
        check(spark, [(i, [2.0 ** 40, 1.0]) for i in range(5)], clusters=1, width=2)


def test_products_stay_exact_and_follow_the_changes():
    pick = np.random.default_rng(3)
    for most in (50, 1 << 27):
        v, c, d = (pick.integers(-most, most, s) for s in ((40, 8), (5, 8), (5, 8)))
        d[:, ::2] = 0
        want = np.array([[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in c + d] for x in v])
        assert (moved(product(v, c.T), v, d) == want).all()
