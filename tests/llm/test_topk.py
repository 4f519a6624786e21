import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import riskspark.llm.topk as topk
from riskspark.llm.topk import accumulate, exact_top


def brute(rows, top, each=20):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    asking = {}
    for i, v in ok:
        if i % each == 0:
            asking[i] = min(asking.get(i, v), v)
    out = []
    for q, v in asking.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:top])]
    return sorted(out)


@pytest.mark.parametrize("slice_rows, block", [(8192, 1024), (40, 3)])
def test_embeddings_against_brute_force(spark, sf, monkeypatch, slice_rows, block):
    monkeypatch.setattr(topk, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = exact_top(df, F.col("vec_id") % 20 == 0)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (20, [0.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None),
            (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [2.0]), (8, []),
            (40, [-3.0, 1e6]), (40, [-4.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("x"))
    got = exact_top(df, F.col("vec_id") % 20 == 0, 4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)
    assert exact_top(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("high, share", [(3, 0.05), (60, 1.0), (10 ** 5, 0.3), (2 ** 26, 0.5)])
def test_accumulated_scores(high, share):
    rng = np.random.default_rng(high)
    q, c = (rng.integers(-high, high, (n, 16)) * (rng.random((n, 16)) < share) for n in (7, 5000))
    assert (accumulate(q, c).astype(np.int64) == q @ c.T).all()
