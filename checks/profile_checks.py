"""Profiling and first aggregates."""

from pyspark.sql import functions as F

from checks.register import check
from checks.tables import FX, FX_FEATURES, FX_SQL, RX_SQL, SPLIT_SQL, fx, rx, table
from riskspark.operators import profile
from riskspark.operators.reshape import to_long
from riskspark.operators.split import hash_split
from riskspark.spec import REGIONAL

# Nulls and NaNs do not occur in the tables; both sides put the same ones in.
HOLES_SQL = """holes AS (
  SELECT NULLIF(l_tax, 0.0) AS l_tax,
         CASE WHEN l_discount = 0.05 THEN 'NaN'::DOUBLE ELSE l_discount END AS l_discount,
         CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS l_returnflag,
         l_quantity FROM lineitem)"""


def holes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.when(F.col("l_discount") == 0.05, F.lit(float("nan"))).otherwise(F.col("l_discount"))
        .alias("l_discount"),
        F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("l_returnflag"),
        "l_quantity")


@check("SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def table_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "lineitem"))


NULLS_SQL = f"""WITH {HOLES_SQL} SELECT
  count(*) FILTER (l_tax IS NULL OR isnan(l_tax)) AS l_tax,
  count(*) FILTER (l_discount IS NULL OR isnan(l_discount)) AS l_discount,
  count(*) FILTER (l_returnflag IS NULL) AS l_returnflag,
  count(*) FILTER (l_quantity IS NULL OR isnan(l_quantity)) AS l_quantity FROM holes"""


@check(NULLS_SQL)
def null_counts(spark, sf_dir):
    return profile.null_counts(holes(spark, sf_dir))


@check(f"""SELECT column_name, nulls FROM ({NULLS_SQL})
           UNPIVOT (nulls FOR column_name IN (l_tax, l_discount, l_returnflag, l_quantity))""")
def null_counts_long(spark, sf_dir):
    return profile.null_counts_long(holes(spark, sf_dir))


@check("""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (
  SELECT count(*) AS n FROM lineitem
  GROUP BY l_quantity, NULLIF(l_tax, 0.0), l_discount, l_returnflag)""")
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem").select(
        "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), "l_discount", "l_returnflag"))


@check(f"WITH {FX_SQL} SELECT * FROM fx ORDER BY id LIMIT 5")
def first_records(spark, sf_dir):
    return profile.first_rows(fx(spark, sf_dir), ["id"])


@check(f"WITH {FX_SQL} SELECT {SPLIT_SQL} AS split, count(*) AS n_rows FROM fx GROUP BY 1")
def split_sizes(spark, sf_dir):
    return profile.split_sizes(hash_split(fx(spark, sf_dir), "id", FX))


@check(f"""WITH {FX_SQL} SELECT """ + ", ".join(
    f"round(avg({f}), 6) AS {f}_mean, round(stddev_samp({f}), 6) AS {f}_std" for f in FX_FEATURES)
       + f" FROM fx WHERE {SPLIT_SQL} = 'train'")
def feature_moments(spark, sf_dir):
    train = hash_split(fx(spark, sf_dir), "id", FX).where("split = 'train'")
    row = profile.moments(train, FX_FEATURES)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@check(f"""WITH {RX_SQL} SELECT feature, count(*) AS n_rows, CAST(sum(value) AS BIGINT) AS total,
  CAST(min(value) AS BIGINT) AS lowest, CAST(max(value) AS BIGINT) AS highest FROM (
  UNPIVOT (SELECT {', '.join(REGIONAL.features)} FROM rx)
  ON {', '.join(REGIONAL.features)} INTO NAME feature VALUE value) GROUP BY feature""")
def random_scenario_report(spark, sf_dir):
    long = to_long(rx(spark, sf_dir), [], list(REGIONAL.features))
    return long.groupBy("feature").agg(
        F.count("*").alias("n_rows"), F.sum("value").cast("bigint").alias("total"),
        F.min("value").cast("bigint").alias("lowest"), F.max("value").cast("bigint").alias("highest"))


@check("""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM
          (SELECT *, count(*) AS n FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 3 = 0)
           GROUP BY ALL)""")
def duplicate_rows_all_columns(spark, sf_dir):
    """On all columns of the line items, a third of which are there twice."""
    items = table(spark, sf_dir, "lineitem")
    return profile.duplicate_rows(items.unionAll(items.where("l_orderkey % 3 = 0")))
