"""Views of the given tables in the shapes the operators expect, in Spark and in SQL.

FX  feature table of line items: four features and a target with spread over all bands
RX  line items as regional observations: 17 integer features 1..10 from the key's hash
EV  events as score requests
RN  orders as a run log
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.scenario import random_scenario
from riskspark.spec import REGIONAL, JobSpec

FX_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
FX = JobSpec(
    features=FX_FEATURES, target="y", dropped=("l_shipdate", "l_returnflag", "l_linestatus"),
    scenarios={"full price": {"l_discount": 0.0, "l_tax": 0.08}, "one piece": {"l_quantity": 1.0},
               "nothing": {}},
    catalogue=(("l_quantity", "q", "Order", 1, 50, "pieces"),
               ("l_extendedprice", "p", "Order", 1, 110000, "list price"),
               ("l_discount", "d", "Terms", 0, 1, "discount share"),
               ("l_tax", "t", "Terms", 0, 1, "tax share")))
# One feature: training has a closed form in SQL.
FX1 = JobSpec(features=("l_extendedprice",), target="y")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The tables hold times without zone; both sides read them as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_id():
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
         * (F.lit(1) + F.col("l_tax")) / F.lit(110000))
    items = table(spark, sf_dir, "lineitem")
    return items.select(_item_id().alias("id"), *FX_FEATURES, y.alias("y"))


FX_SQL = """fx AS (
  SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS id,
         l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) / 110000 AS y
  FROM lineitem)"""


def rx(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fx(spark, sf_dir).select("id", "y")
    names = [*REGIONAL.features, *REGIONAL.dropped]
    features = random_scenario(base, "id", names)
    total = sum((F.col(f) for f in REGIONAL.features[1:]), F.col(REGIONAL.features[0]))
    return features.withColumn(REGIONAL.target, (total - 17) / F.lit(306) + F.col("y") / 2).drop("y")


def _rx_sql() -> str:
    digits = ("CAST(('0x' || substr(md5('{b}:' || id), 1, 15))::BIGINT // {power} % 10 + 1 AS INTEGER)"
              ' AS "{n}"')
    names = [*REGIONAL.features, *REGIONAL.dropped]
    total = " + ".join(f'"{f}"' for f in REGIONAL.features)
    return (f"{FX_SQL},\nrx0 AS (SELECT id, y, " + ", ".join(
        digits.format(b=i // 15, power=10 ** (i % 15), n=n) for i, n in enumerate(names))
        + f" FROM fx),\nrx AS (SELECT * EXCLUDE (y), ({total} - 17) / 306.0::DOUBLE + y / 2 "
        f'AS "{REGIONAL.target}" FROM rx0)')


RX_SQL = _rx_sql()


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def rn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: status F is a success, urgent orders are preparations, the rest trainings."""
    orders = table(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "success")
              .when(F.col("o_orderstatus") == "O", "failed"))
    preparing = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.when(preparing, "preparation").otherwise("training").alias("experiment"),
        F.col("o_orderpriority").alias("run_name"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        F.create_map(F.lit("best_model_name"),
                     F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")),
                     F.lit("custkey"), F.col("o_custkey").cast("string")).alias("params"),
        F.create_map(F.lit("best_RMSE"),
                     F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice"))).alias("metrics"),
        F.create_map(F.lit("status"), status).alias("tags"))


RN_SQL = """rn AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'preparation'
              ELSE 'training' END AS experiment,
         o_orderpriority AS run_name, o_orderdate AS start_time,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS best_model_name,
         CAST(o_custkey AS VARCHAR) AS custkey,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS best_rmse,
         CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' END AS status
  FROM orders)"""

# Split and fold of FX in SQL, from the same hash bits as the operators.
SPLIT_SQL = "CASE WHEN substr(md5('42:' || id), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END"
FOLD_SQL = "CAST(('0x' || substr(md5(id), 9, 8))::BIGINT % 3 AS INTEGER)"


def us_text(column: str) -> str:
    """SQL for microseconds of an event time."""
    return f"epoch_us({column})"
