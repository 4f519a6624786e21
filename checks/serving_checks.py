"""History, rate limit, cool-down and result reuse on the event table."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from checks.register import check
from checks.tables import ev
from riskspark.functions import columns as C
from riskspark.operators import serving

DAY = 86_400
WINDOW_SQL = f"epoch_us(ts) - epoch_us(ts) % {DAY * 1_000_000}"
LIMITED_SQL = f"""numbered AS (SELECT event_id, user_id, ts, {WINDOW_SQL} AS window_us, row_number() OVER
    (PARTITION BY user_id, {WINDOW_SQL} ORDER BY ts, event_id) AS position FROM events),
limited AS (SELECT *, position <= 3 AS allowed FROM numbered)"""


@check("""SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
          AS number FROM events""")
def number_history(spark, sf_dir):
    out = serving.number_history(ev(spark, sf_dir), "user_id", "ts", "event_id")
    return out.select("event_id", "user_id", "number")


@check("""SELECT event_id, user_id, value, CAST(recency AS INTEGER) AS recency, number FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS recency,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number
  FROM events) WHERE recency <= 5""")
def recent_history(spark, sf_dir):
    out = serving.recent_history(ev(spark, sf_dir), "user_id", "ts", "event_id")
    return out.select("event_id", "user_id", "value", "recency", "number")


@check("""SELECT user_id, event_id, event_type, value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_result(spark, sf_dir):
    out = serving.latest_result(ev(spark, sf_dir), "user_id", "ts", "event_id")
    return out.select("user_id", "event_id", "event_type", "value")


@check("SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def retain_history(spark, sf_dir):
    cutoff = datetime(2024, 1, 20, tzinfo=timezone.utc)
    return serving.retain_since(ev(spark, sf_dir), "ts", cutoff).select("event_id", "user_id", "value")


@check(f"WITH {LIMITED_SQL} SELECT event_id, user_id, window_us, position FROM limited")
def window_position(spark, sf_dir):
    out = serving.rate_limit(ev(spark, sf_dir), "user_id", "ts", "event_id", 3, DAY)
    return out.select("event_id", "user_id", "window_us", "position")


@check(f"""WITH {LIMITED_SQL} SELECT event_id, allowed, CASE WHEN allowed THEN 0 ELSE
  CAST(ceil((window_us + {DAY * 1_000_000} - epoch_us(ts)) / 1e6) AS INTEGER) END AS retry_after
  FROM limited""")
def rate_limit(spark, sf_dir):
    out = serving.rate_limit(ev(spark, sf_dir), "user_id", "ts", "event_id", 3, DAY)
    return out.select("event_id", "allowed", "retry_after")


@check(f"""SELECT user_id, {WINDOW_SQL} AS window_us, count(*) AS requests, count(*) > 3 AS over_limit
           FROM events GROUP BY 1, 2""")
def window_counts(spark, sf_dir):
    return serving.window_counts(ev(spark, sf_dir), "user_id", "ts", 3, DAY)


@check(f"""WITH {LIMITED_SQL}, previous AS (SELECT *, lag(allowed) OVER w AS was_allowed,
    lag(epoch_us(ts)) OVER w AS was_us FROM limited WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, allowed, CASE WHEN was_allowed = false THEN CAST(greatest(trunc(
  {DAY} - (epoch_us(ts) - was_us) / 1e6), 0) AS INTEGER) ELSE 0 END AS wait FROM previous""")
def cooldown(spark, sf_dir):
    limited = serving.rate_limit(ev(spark, sf_dir), "user_id", "ts", "event_id", 3, DAY)
    out = serving.cooldown(limited, "user_id", "ts", "event_id", seconds=DAY)
    return out.select("event_id", "allowed", "wait")


@check("""WITH e AS (SELECT event_id, epoch_us(ts) AS us, epoch_us(lag(ts) OVER
            (PARTITION BY user_id ORDER BY ts, event_id)) AS before FROM events)
SELECT event_id, CAST(greatest(trunc(36000 - (us - before) / 1e6), 0) AS INTEGER) AS left_seconds
FROM e WHERE before IS NOT NULL""")
def remaining_seconds(spark, sf_dir):
    from riskspark.operators.ordered import running_fold
    us = ev(spark, sf_dir).withColumn("us", C.micros("ts"))
    before = running_fold(us, ["user_id"], ["ts", "event_id"], {"before": ("last", F.col("us"))},
                          include_current=False)
    return before.where("before is not null").select(
        "event_id", C.remaining_seconds("us", "before", 36000).alias("left_seconds"))


def _reuse_sql(seconds: int, result: str) -> str:
    return f"""WITH RECURSIVE e AS (SELECT event_type AS key, epoch_us(ts) AS us, min(event_id) AS event_id
    FROM events GROUP BY 1, 2),
nxt AS MATERIALIZED (SELECT a.key, a.us, b.us AS next_us FROM
    (SELECT key, us, us + {seconds * 1_000_000} AS due FROM e) a
    ASOF LEFT JOIN e b ON a.key = b.key AND b.us >= a.due),
computed AS (SELECT key, min(us) AS us FROM e GROUP BY key
    UNION ALL SELECT n.key, n.next_us FROM computed c JOIN nxt n ON n.key = c.key AND n.us = c.us
    WHERE n.next_us IS NOT NULL),
served AS (SELECT ev.event_id, ev.event_type, epoch_us(ev.ts) AS us, c.us AS computed_us
    FROM events ev ASOF JOIN computed c ON ev.event_type = c.key AND epoch_us(ev.ts) >= c.us),
flagged AS (SELECT s.*, NOT (s.us = s.computed_us AND s.event_id = e.event_id) AS hit
    FROM served s JOIN e ON e.key = s.event_type AND e.us = s.us)
{result}"""


@check(_reuse_sql(600, "SELECT event_id, computed_us, hit FROM flagged"))
def reuse_results(spark, sf_dir):
    out = serving.reuse_results(ev(spark, sf_dir), "event_type", "ts", "event_id", 600)
    return out.select("event_id", "computed_us", "hit")


@check(_reuse_sql(36000, """SELECT event_type, count(*) AS requests, count(*) FILTER (hit) AS hits
                            FROM flagged GROUP BY event_type"""))
def reuse_report(spark, sf_dir):
    out = serving.reuse_results(ev(spark, sf_dir), "event_type", "ts", "event_id", 36000)
    return out.groupBy("event_type").agg(F.count("*").alias("requests"),
                                         F.count_if("hit").alias("hits"))


CACHE_SQL = """WITH k AS (SELECT event_id, user_id || ':' || event_type || ':' ||
    CAST(CAST(trunc(value / 10) AS INTEGER) AS VARCHAR) AS key, ts FROM events),
cache AS (SELECT DISTINCT key FROM k WHERE ts < TIMESTAMP '2024-01-08'),
asked AS (SELECT * FROM k WHERE ts >= TIMESTAMP '2024-01-08')
SELECT event_id, key FROM asked WHERE key {} IN (SELECT key FROM cache)"""


def _cache_parts(spark, sf_dir):
    keyed = ev(spark, sf_dir).withColumn("key", F.concat_ws(
        ":", "user_id", "event_type", (F.col("value") / 10).cast("int")))
    limit = F.lit("2024-01-08").cast("timestamp")
    cache = keyed.where(F.col("ts") < limit).select("key").distinct()
    return serving.cache_lookup(keyed.where(F.col("ts") >= limit), cache, "key")


@check(CACHE_SQL.format(""))
def cache_hits(spark, sf_dir):
    return _cache_parts(spark, sf_dir)[0].select("event_id", "key")


@check(CACHE_SQL.format("NOT"))
def cache_misses(spark, sf_dir):
    return _cache_parts(spark, sf_dir)[1].select("event_id", "key")


@check("""WITH k AS (SELECT event_id, ts, CASE WHEN value >= 10 THEN user_id || ':' || event_type END AS key FROM events),
cache AS (SELECT DISTINCT key FROM k WHERE ts < TIMESTAMP '2024-01-03')
SELECT event_id, k.key, c.found IS NOT NULL AS cached FROM k
LEFT JOIN (SELECT key, true AS found FROM cache) c ON k.key IS NOT DISTINCT FROM c.key
WHERE ts >= TIMESTAMP '2024-01-03'""")
def cache_flags(spark, sf_dir):
    """Hits and misses in one frame; a null key is a key."""
    keyed = ev(spark, sf_dir).withColumn("key", F.when(
        F.col("value") >= 10, F.concat_ws(":", "user_id", "event_type")))
    limit = F.lit("2024-01-03").cast("timestamp")
    cache = keyed.where(F.col("ts") < limit).select("key")
    out = serving.flag_cached(keyed.where(F.col("ts") >= limit), cache, "key")
    return out.select("event_id", "key", "cached")
