"""Sources and sinks: every write is read back and must hold the same rows."""

from pyspark.sql import functions as F

from checks.register import check
from checks.tables import FX, FX_FEATURES, FX_SQL, RX_SQL, SPLIT_SQL, ev, fx, rx, table
from riskspark.operators.profile import split_sizes
from riskspark.operators.scoring import responses
from riskspark.operators.split import hash_split
from riskspark.session import work_path
from riskspark.sources import files, requests
from riskspark.spec import REGIONAL

SAMPLE_LIST = "[" + ", ".join(FX_FEATURES) + "]"


@check("SELECT * REPLACE (epoch_us(l_shipdate) AS l_shipdate) FROM lineitem")
def read_source(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = files.read_source(spark, f"{sf_dir}/lineitem.parquet", "parquet")
    return df.withColumn("l_shipdate", F.unix_micros(F.col("l_shipdate").cast("timestamp")))


@check("SELECT * FROM part")
def write_csv(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = work_path(spark, "csv")
    files.write_csv(part, path)
    return files.read_csv(spark, path, part.schema)


@check("""SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, l_returnflag,
                 count(*) AS n, round(sum(l_quantity), 2) AS quantity,
                 round(max(l_tax), 2) AS tax FROM lineitem GROUP BY ALL""")
def read_csv_inferred(spark, sf_dir):
    path = work_path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "lineitem").select(
        "l_linenumber", "l_returnflag", "l_quantity", "l_tax"), path)
    return (files.read_csv(spark, path).groupBy("l_linenumber", "l_returnflag")
            .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"),
                 F.round(F.max("l_tax"), 2).alias("tax")))


# Whole numbers below 2^31 are read back as integers, texts of dates and times as timestamps.
@check("SELECT * REPLACE (" + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in (
    "l_orderkey", "l_partkey", "l_suppkey")) + ", epoch_us(l_shipdate) AS l_shipdate) FROM lineitem")
def read_csv_inferred_rows(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = work_path(spark, "csv")
    items = table(spark, sf_dir, "lineitem")
    files.write_csv(items.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")), path)
    return files.read_csv(spark, path).withColumn("l_shipdate", F.unix_micros("l_shipdate"))


@check(f"WITH {FX_SQL} SELECT id, l_quantity, l_extendedprice, l_discount, l_tax, y, "
       f"{SPLIT_SQL} AS split FROM fx")
def write_prepared(spark, sf_dir):
    path = work_path(spark, "prepared")
    files.write_prepared(hash_split(fx(spark, sf_dir), "id", FX), path, ["split"])
    return files.read_prepared(spark, path).withColumn("split", F.col("split").cast("string"))


@check(f"WITH {FX_SQL} SELECT {SPLIT_SQL} AS split, count(*) AS n_rows FROM fx GROUP BY 1")
def read_prepared(spark, sf_dir):
    path = work_path(spark, "prepared")
    files.write_prepared(hash_split(fx(spark, sf_dir), "id", FX), path, ["split"])
    return split_sizes(files.read_prepared(spark, path)).withColumn(
        "split", F.col("split").cast("string"))


@check(f"WITH {FX_SQL} SELECT id, l_quantity, l_extendedprice, l_discount, l_tax FROM fx")
def requests_to_df(spark, sf_dir):
    values = fx(spark, sf_dir).select("id", F.array(*FX_FEATURES).alias("values"))
    return requests.requests_to_df(values, "values", FX_FEATURES)


@check("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                 CAST(NULL AS VARCHAR) AS extra FROM events""")
def parse_json_requests(spark, sf_dir):
    parsed = requests.parse_requests(ev(spark, sf_dir), "props", ["k", "extra"])
    return parsed.select("event_id", F.col("k").cast("double").alias("k"), "extra")


@check("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN props || '}{' END IS NOT NULL
                 AND event_id % 10 = 0 AS broken,
                 CASE WHEN event_id % 10 <> 0 THEN json_extract_string(props, '$.k') END AS k
          FROM events""")
def parse_corrupt_requests(spark, sf_dir):
    text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("no json: "), F.col("props")))
    raw = ev(spark, sf_dir).withColumn("text", F.coalesce(text, F.col("props")))
    parsed = requests.parse_requests(raw, "text", ["k"])
    return parsed.select("event_id", F.col("corrupt").isNotNull().alias("broken"), "k")


@check(f"WITH {RX_SQL} SELECT id, "
       + ", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in REGIONAL.features) + " FROM rx")
def request_json_round_trip(spark, sf_dir):
    sent = rx(spark, sf_dir).select("id", F.to_json(F.struct(*REGIONAL.features)).alias("body"))
    parsed = requests.parse_requests(sent, "body", REGIONAL.features)
    return parsed.select("id", *[F.col(f).cast("double").alias(f) for f in REGIONAL.features])


@check(f"WITH {FX_SQL} SELECT id, y AS prediction, 4 AS features_used, 'success' AS status FROM fx")
def response_rows(spark, sf_dir):
    return responses(fx(spark, sf_dir), ["id"], len(FX_FEATURES), "y")


@check("""SELECT l_orderkey, l_linenumber, '{"prediction":' || CAST(l_linenumber AS VARCHAR)
                 || '.0,"features_used":4,"status":"success"}' AS response FROM lineitem""")
def response_json(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("score", F.col("l_linenumber").cast("double"))
    ids = ["l_orderkey", "l_linenumber"]
    return requests.response_json(responses(items, ids, 4, "score"), ids)


@check(f"""WITH {FX_SQL}, one AS (SELECT * FROM fx ORDER BY id LIMIT 1)
SELECT 4 AS feature_count, pos, name, role, sample FROM (
  SELECT 0 AS pos, 'l_quantity' AS name, 'feature' AS role, l_quantity AS sample FROM one
  UNION ALL SELECT 1, 'l_extendedprice', 'feature', l_extendedprice FROM one
  UNION ALL SELECT 2, 'l_discount', 'feature', l_discount FROM one
  UNION ALL SELECT 3, 'l_tax', 'feature', l_tax FROM one
  UNION ALL SELECT NULL, 'y', 'target', y FROM one)""")
def feature_catalogue(spark, sf_dir):
    return requests.catalogue(fx(spark, sf_dir), FX, ["id"])
