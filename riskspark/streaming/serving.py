"""Rate limit, result reuse, window counts and scoring on request streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.operators.serving import (latest_result, rate_limit, reuse_results,
                                         window_counts)
from riskspark.plans.scoring import score_requests
from riskspark.spec import JobSpec, REQUESTS_PER_WINDOW, REUSE_SECONDS, WINDOW_SECONDS
from riskspark.streaming.keyed import merge_stream
from riskspark.streaming.stateful import release, run_stateful


def rate_limit_stream(df: DataFrame, client: str, ts: str, id: str, root: str,
                      limit: int = REQUESTS_PER_WINDOW, seconds: int = WINDOW_SECONDS,
                      delay_seconds: int = 600) -> StreamingQuery:
    """The batch rate limit over a stream; the state is the count per client and window."""
    keys = [client, "window_us"]

    def step(batch, state):
        return rate_limit(batch, client, ts, id, limit, seconds,
                          None if state is None else state.drop("expiry_us"))

    def remember(output, state):
        counts = output.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        if state is not None:
            counts = (counts.unionByName(state.drop("expiry_us"))
                      .groupBy(*keys).agg(F.sum("rows").alias("rows")))
        return counts.withColumn("expiry_us", F.col("window_us") + seconds * 1_000_000)

    return run_stateful(df, ts, step, remember, "expiry_us", root, delay_seconds)


def reuse_stream(df: DataFrame, key: str, ts: str, id: str, root: str,
                 seconds: int = REUSE_SECONDS, delay_seconds: int = 600) -> StreamingQuery:
    """The batch result reuse over a stream; the state is the last computation per key.

    Rows wait until the delay has closed their time, so they are served in time order, however
    they arrive. The last computation takes part in the next stretch as its key's first
    request, and so serves or expires exactly as it would have in one long batch. Call
    ``reuse_release`` at the end of a stream for what still waits.
    """
    step = _reuse_step(key, ts, id, seconds)

    def remember(output, state):
        computed = output.select(key, "computed_us")
        if state is not None:
            computed = computed.unionByName(state.drop("expiry_us"))
        return (computed.groupBy(key).agg(F.max("computed_us").alias("computed_us"))
                .withColumn("expiry_us", F.col("computed_us") + seconds * 1_000_000))

    return run_stateful(df, ts, step, remember, "expiry_us", root, delay_seconds, in_order=True)


def _reuse_step(key: str, ts: str, id: str, seconds: int):
    def step(batch, state):
        rows = batch.withColumn("_earlier", F.lit(False))
        if state is not None:
            first = state.select(key, F.timestamp_micros("computed_us").alias(ts),
                                 F.lit(True).alias("_earlier"))
            rows = rows.unionByName(first, allowMissingColumns=True)
        served = reuse_results(rows, key, ts, id, seconds)
        return served.where("not _earlier").drop("_earlier")
    return step


def reuse_release(spark: SparkSession, key: str, ts: str, id: str, root: str,
                  seconds: int = REUSE_SECONDS) -> None:
    """Serve the requests that still wait when a ``reuse_stream`` has ended."""
    release(spark, root, _reuse_step(key, ts, id, seconds))


def window_counts_stream(df: DataFrame, client: str, ts: str, limit: int = REQUESTS_PER_WINDOW,
                         seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Requests per client and window, for complete mode (every window so far)."""
    return window_counts(df, client, ts, limit, seconds)


def closed_window_counts(df: DataFrame, client: str, ts: str, limit: int = REQUESTS_PER_WINDOW,
                         seconds: int = WINDOW_SECONDS) -> DataFrame:
    """The same for append mode: a window is emitted once, when the watermark has passed it."""
    return (df.groupBy(client, F.window(ts, f"{seconds} seconds").alias("_window"))
            .agg(F.count(F.lit(1)).alias("requests"))
            .select(client, F.unix_micros("_window.start").alias("window_us"), "requests",
                    (F.col("requests") > limit).alias("over_limit")))


def latest_result_stream(df: DataFrame, client: str, ts: str, id: str) -> DataFrame:
    """The newest row per client so far."""
    return latest_result(df, client, ts, id)


def latest_result_table(df: DataFrame, client: str, ts: str, id: str, root: str,
                        buckets: int = 256) -> StreamingQuery:
    """The same as a table of which a batch rewrites only the buckets of its clients.

    Read it with ``keyed.read_merged``. A row that arrives late just loses against a newer one, so
    no row has to wait or is set aside.
    """
    return merge_stream(df, client, lambda rows: latest_result(rows, client, ts, id), root, buckets)


def score_stream(df: DataFrame, ids: list[str], model: PipelineModel, spec: JobSpec,
                 link: str = "identity", scaled: bool = True) -> DataFrame:
    """Responses to the good requests of a stream; the plan is the one of the batch job."""
    return score_requests(df, ids, model, spec, link, scaled)[0]
