"""Streams over the event and line item tables; they must equal the batch results.

The input arrives in three parts in event order, one per micro-batch, so that state
crosses batches.
"""

from pyspark.sql import functions as F

from checks.register import check
from checks.scoring_checks import ADVICE_SQL, BAND_SQL, LINE_SQL, line_model
from checks.serving_checks import DAY, LIMITED_SQL, WINDOW_SQL, _reuse_sql
from checks.tables import FX1, ev, fx
from riskspark.session import work_path
from riskspark.streaming import events as E
from riskspark.streaming import serving as S
from riskspark.streaming.keyed import read_merged
from riskspark.streaming.stateful import read_output

STARTS = ("2024-01-11", "2024-01-21")


def event_feed(spark, sf_dir, order=(0, 1, 2)):
    """The events as a stream of three batches, however many files the table has.

    A task of the scan writes a file of a part; empty files bring all parts to the same number,
    which then is a batch.
    """
    events = ev(spark, sf_dir)
    path = work_path(spark, "feed")
    files = max(1, events.rdd.getNumPartitions())
    nothing = spark.createDataFrame([], events.schema)
    bounds = [None, *[F.lit(s).cast("timestamp") for s in STARTS], None]
    for turn, (low, high) in enumerate([(bounds[i], bounds[i + 1]) for i in order], 1):
        part = events
        if low is not None:
            part = part.where(F.col("ts") >= low)
        if high is not None:
            part = part.where(F.col("ts") < high)
        part.write.mode("append").parquet(path)
        written = len(spark.read.schema(events.schema).parquet(path).inputFiles())
        for _ in range(turn * files - written):
            nothing.write.mode("append").parquet(path)
    stream = E.read_stream(spark, path, events.schema, max_files=files)
    return E.with_event_time(stream)


def drained(spark, df, mode="append"):
    """Run the stream to its end and read what it wrote."""
    path = work_path(spark, "stream")
    query = E.write_stream(df, path, work_path(spark, "stream-checkpoint"), mode)
    query.awaitTermination()
    return spark.read.parquet(path) if mode == "append" else E.read_complete(spark, path)


@check(f"WITH {LIMITED_SQL} SELECT event_id, user_id, window_us, position, allowed FROM limited")
def stream_rate_limit(spark, sf_dir):
    root = work_path(spark, "limited")
    S.rate_limit_stream(event_feed(spark, sf_dir), "user_id", "ts", "event_id", root, 3,
                        DAY).awaitTermination()
    return read_output(spark, root).select("event_id", "user_id", "window_us", "position", "allowed")


@check(_reuse_sql(600, "SELECT event_id, computed_us, hit FROM flagged"))
def stream_reuse(spark, sf_dir):
    root = work_path(spark, "reused")
    S.reuse_stream(event_feed(spark, sf_dir), "event_type", "ts", "event_id", root,
                   600).awaitTermination()
    S.reuse_release(spark, "event_type", "ts", "event_id", root, 600)
    return read_output(spark, root).select("event_id", "computed_us", "hit")


@check(_reuse_sql(600, "SELECT event_id, computed_us, hit FROM flagged"))
def stream_reuse_out_of_order(spark, sf_dir):
    """The last third arrives before the middle one; a delay of 30 days keeps all in time."""
    root = work_path(spark, "reused")
    S.reuse_stream(event_feed(spark, sf_dir, order=(0, 2, 1)), "event_type", "ts", "event_id", root,
                   600, 30 * 86_400).awaitTermination()
    S.reuse_release(spark, "event_type", "ts", "event_id", root, 600)
    return read_output(spark, root).select("event_id", "computed_us", "hit")


@check("""SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-11'
          AND ts < TIMESTAMP '2024-01-21'
          AND epoch_us(ts) < (SELECT max(epoch_us(ts)) - 600000000 FROM events)""")
def stream_late_rows(spark, sf_dir):
    """The middle third arrives last; all of it is behind the watermark and set aside."""
    root = work_path(spark, "late")
    S.rate_limit_stream(event_feed(spark, sf_dir, order=(0, 2, 1)), "user_id", "ts", "event_id",
                        root, 3, DAY).awaitTermination()
    return read_output(spark, root, "late").select("event_id", "user_id")


@check(f"""SELECT user_id, {WINDOW_SQL} AS window_us, count(*) AS requests, count(*) > 3 AS over_limit
           FROM events GROUP BY 1, 2""")
def stream_window_counts(spark, sf_dir):
    out = S.window_counts_stream(event_feed(spark, sf_dir), "user_id", "ts", 3, DAY)
    return drained(spark, out, "complete")


@check(f"""SELECT user_id, {WINDOW_SQL} AS window_us, count(*) AS requests, count(*) > 3 AS over_limit
           FROM events GROUP BY 1, 2
           HAVING window_us + {DAY * 1_000_000} <= (SELECT max(epoch_us(ts)) - 600000000 FROM events)""")
def stream_closed_windows(spark, sf_dir):
    """Append mode: only windows that the watermark has passed."""
    out = S.closed_window_counts(event_feed(spark, sf_dir), "user_id", "ts", 3, DAY)
    return drained(spark, out)


@check("""SELECT user_id, event_id, event_type, value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_latest_result(spark, sf_dir):
    feed, root = event_feed(spark, sf_dir), work_path(spark, "latest")
    S.latest_result_table(feed, "user_id", "ts", "event_id", root, 16).awaitTermination()
    return read_merged(spark, root, feed.schema).select("user_id", "event_id", "event_type", "value")


@check(f"""SELECT user_id, event_id, event_type, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
             AND ts >= TIMESTAMP '{STARTS[1]}'""")
def stream_latest_updates(spark, sf_dir):
    """Update mode: the clients whose newest row came with the third batch."""
    feed, root = event_feed(spark, sf_dir), work_path(spark, "latest")
    S.latest_result_table(feed, "user_id", "ts", "event_id", root, 16).awaitTermination()
    return (read_merged(spark, root, feed.schema, since=2)
            .select("user_id", "event_id", "event_type", "value"))


@check("""SELECT user_id, event_id, event_type, value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_latest_complete(spark, sf_dir):
    out = S.latest_result_stream(event_feed(spark, sf_dir), "user_id", "ts", "event_id")
    return drained(spark, out, "complete").select("user_id", "event_id", "event_type", "value")


@check(f"""WITH {LINE_SQL}, s AS (SELECT id, w * l_extendedprice + b AS s FROM fx, line)
SELECT id, round(s, 6) AS prediction, 1 AS features_used, 'success' AS status,
  {BAND_SQL.format(s='s')} AS band, {ADVICE_SQL.format(s='s')} AS advice,
  round(least(s * 100, 100.0), 6) AS percent FROM s""")
def stream_scoring(spark, sf_dir):
    asked = fx(spark, sf_dir).select("id", "l_extendedprice", (F.crc32("id") % 2).alias("part"))
    path = work_path(spark, "feed")
    asked.write.partitionBy("part").parquet(path)
    stream = E.read_stream(spark, path, "id string, l_extendedprice double", max_files=1,
                           recursiveFileLookup="true")
    out = S.score_stream(stream, ["id"], line_model(spark, sf_dir), FX1)
    return drained(spark, out).withColumns(
        {c: F.round(c, 6) for c in ("prediction", "percent")})
