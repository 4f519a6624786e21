"""Projection, validation, split, scaling, reshaping."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.register import check
from checks.tables import (FOLD_SQL, FX, FX_FEATURES, FX_SQL, RX_SQL, SPLIT_SQL, fx, rn, RN_SQL, rx,
                           table)
from riskspark.functions import columns as C
from riskspark.operators import prepare, reshape, scaling, scenario, split
from riskspark.spec import REGIONAL

KEPT = ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"]
FEATURES_SQL = ", ".join(f'"{f}"' for f in REGIONAL.features)


@check("SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem")
def drop_columns(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return prepare.drop_columns(items, [c for c in items.columns if c not in KEPT] + ["no_such_column"])


@check(f"WITH {RX_SQL} SELECT id, {FEATURES_SQL}, FloodProbability FROM rx")
def select_features(spark, sf_dir):
    return prepare.select_features(rx(spark, sf_dir), REGIONAL, ["id"])


@check(f"""WITH {RX_SQL} SELECT name, pos - 1 AS pos FROM (
  SELECT unnest(list_filter(columns, lambda c: c NOT IN
    ('PoliticalFactors', 'InadequatePlanning', 'PopulationScore'))) AS name,
    CAST(generate_subscripts(list_filter(columns, lambda c: c NOT IN
    ('PoliticalFactors', 'InadequatePlanning', 'PopulationScore')), 1) AS INTEGER) AS pos
  FROM (SELECT json_keys(to_json(rx)) AS columns FROM rx LIMIT 1))""")
def remaining_columns(spark, sf_dir):
    df = rx(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in prepare.remaining_columns(df, REGIONAL.dropped)])
    return df.limit(1).select(F.posexplode(names).alias("pos", "name"))


# What is left after the drop is known from the names; its values are read from all rows.
LEFT_SQL = ["id", *REGIONAL.features, REGIONAL.target]


@check(f"WITH {RX_SQL} " + " UNION ALL ".join(
    f"""SELECT {i} AS pos, '{c}' AS name, count("{c}") AS n, CAST(min("{c}") AS VARCHAR) AS least
        FROM rx""" if c != REGIONAL.target else
    f"""SELECT {i} AS pos, '{c}' AS name, count("{c}") AS n, NULL AS least FROM rx"""
    for i, c in enumerate(LEFT_SQL)))
def remaining_column_values(spark, sf_dir):
    df = rx(spark, sf_dir)
    left = prepare.remaining_columns(df, REGIONAL.dropped)
    least = {c: F.min(c).cast("string") if c != REGIONAL.target else F.lit(None).cast("string")
             for c in left}
    rows = df.agg(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"),
                                     F.count(c).alias("n"), least[c].alias("least"))
                            for i, c in enumerate(left)]).alias("rows"))
    return rows.select(F.inline("rows"))


@check(f"""WITH {FX_SQL} SELECT id, l_quantity + l_extendedprice + l_discount + l_tax AS total,
                  l_extendedprice AS second, 4 AS n FROM fx""")
def assemble_vector(spark, sf_dir):
    values = vector_to_array(F.col("features"))
    return (prepare.assemble(fx(spark, sf_dir), FX_FEATURES)
            .select("id", F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("total"),
                    values[1].alias("second"), F.size(values).alias("n")))


@check("SELECT vec_id, label, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(64)) + " FROM embeddings")
def expand_vector(spark, sf_dir):
    vectors = prepare.vector_from_array(table(spark, sf_dir, "embeddings"), "embedding")
    return prepare.expand_vector(vectors.drop("embedding"), "features", [f"x{i}" for i in range(64)])


BAD_SQL = """bad AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_linenumber = 7 THEN 'abc' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END
      AS l_quantity,
    NULLIF(l_tax, 0.0) AS l_tax,
    CASE WHEN l_discount = 0.05 THEN 'NaN'::DOUBLE ELSE l_discount END AS l_discount
  FROM lineitem),
reasons AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax, l_discount, concat_ws('; ',
    CASE WHEN TRY_CAST(l_quantity AS DOUBLE) IS NULL THEN 'not a number: l_quantity'
         WHEN NOT TRY_CAST(l_quantity AS DOUBLE) BETWEEN 0.01 AND 40 THEN 'out of range: l_quantity' END,
    CASE WHEN l_tax IS NULL THEN 'missing: l_tax'
         WHEN NOT l_tax BETWEEN 0.01 AND 40 THEN 'out of range: l_tax' END,
    CASE WHEN isnan(l_discount) THEN 'not a number: l_discount'
         WHEN NOT l_discount BETWEEN 0.01 AND 40 THEN 'out of range: l_discount' END) AS reason
  FROM bad)"""


def bad_requests(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_linenumber") == 7, "abc")
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("l_quantity"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.when(F.col("l_discount") == 0.05, F.lit(float("nan"))).otherwise(F.col("l_discount"))
        .alias("l_discount"))


@check("""SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('; ', CASE
    WHEN l_quantity < 6 THEN 'out of range: l_quantity' END, 'missing: l_colour') AS reason FROM lineitem""")
def validate_lacking_column(spark, sf_dir):
    """A feature that the table lacks rejects every row; one bound alone is a range."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    checked = prepare.validate(items, ["l_quantity", "l_colour"], low=6)
    none = prepare.accepted(checked, ["l_quantity", "l_colour"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit("accepted").alias("reason"))
    return prepare.rejected(checked).drop("l_quantity").unionByName(none)


@check("""SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber IN (1, 2, 3) AS good FROM lineitem""")
def validate_number_text(spark, sf_dir):
    """What a cast takes beyond plain numbers is no number."""
    forms = F.array(*map(F.lit, ("5", " -5.5e1 ", ".5", "5d", "1f", "Infinity", "0x1")))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", forms[F.col("l_linenumber") - 1].alias("text"))
    return prepare.validate(items, ["text"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("ok").alias("good"))


VALIDATED = ["l_quantity", "l_tax", "l_discount"]


@check(f"""WITH {BAD_SQL} SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(l_quantity AS DOUBLE) AS l_quantity, l_tax, l_discount FROM reasons WHERE reason = ''""")
def validate_accepted(spark, sf_dir):
    checked = prepare.validate(bad_requests(spark, sf_dir), VALIDATED, 0.01, 40)
    return prepare.accepted(checked, VALIDATED)


@check(f"""WITH {BAD_SQL} SELECT l_orderkey, l_linenumber, l_partkey, reason FROM reasons
           WHERE reason <> ''""")
def validate_rejected(spark, sf_dir):
    checked = prepare.validate(bad_requests(spark, sf_dir), VALIDATED, 0.01, 40)
    return prepare.rejected(checked).drop(*VALIDATED)


@check(f"WITH {FX_SQL} SELECT id, {SPLIT_SQL} AS split FROM fx")
def hash_split(spark, sf_dir):
    return split.hash_split(fx(spark, sf_dir).select("id"), "id", FX)


@check("SELECT count(*) AS n_rows, true AS disjoint, true AS near_share FROM lineitem")
def bernoulli_split(spark, sf_dir):
    """Which rows fall where depends on Spark's generator; the parts must add up to the table."""
    train, test = split.bernoulli_split(fx(spark, sf_dir).withColumn(
        "row", F.monotonically_increasing_id()), FX)
    parts = train.withColumn("part", F.lit(1)).unionByName(test.withColumn("part", F.lit(0)))
    rows = parts.groupBy("row").agg(F.count("*").alias("n"), F.max("part").alias("part"))
    return rows.agg(F.sum("n").alias("n_rows"), (F.max("n") == 1).alias("disjoint"),
                    F.avg("part").between(0.75, 0.85).alias("near_share"))


@check(f"WITH {FX_SQL} SELECT id, {FOLD_SQL} AS fold FROM fx")
def assign_folds(spark, sf_dir):
    return split.assign_folds(fx(spark, sf_dir).select("id"), "id", FX)


@check(f"WITH {RX_SQL} SELECT id, {FEATURES_SQL} FROM rx")
def random_scenario(spark, sf_dir):
    return scenario.random_scenario(fx(spark, sf_dir).select("id"), "id", REGIONAL.features)


STATS_SQL = f"""stats AS (SELECT {', '.join(
    f'avg({f}) AS {f}_m, stddev_samp({f}) AS {f}_s' for f in FX_FEATURES)}
  FROM fx WHERE {SPLIT_SQL} = 'train')"""
SCALED_SQL = ", ".join(f"round(CASE WHEN {f}_s = 0 THEN 0.0 ELSE ({f} - {f}_m) / {f}_s END, 6) AS {f}"
                       for f in FX_FEATURES)


@check(f"WITH {FX_SQL}, {STATS_SQL} SELECT id, {SCALED_SQL}, y FROM fx, stats")
def standardise(spark, sf_dir):
    df = fx(spark, sf_dir)
    train = split.hash_split(df, "id", FX).where("split = 'train'")
    out = scaling.standardise(df, FX_FEATURES, train)
    return out.select("id", *[F.round(f, 6).alias(f) for f in FX_FEATURES], "y")


@check(f"WITH {FX_SQL}, {STATS_SQL} SELECT id, {SCALED_SQL} FROM fx, stats")
def scaler_model(spark, sf_dir):
    df = fx(spark, sf_dir)
    train = split.hash_split(df, "id", FX).where("split = 'train'")
    model = scaling.fit_scaler_model(train, FX_FEATURES)
    scaled = prepare.expand_vector(model.transform(df).select("id", "features_scaled"),
                                   "features_scaled", FX_FEATURES)
    return scaled.select("id", *[F.round(f, 6).alias(f) for f in FX_FEATURES])


@check("""WITH s AS (SELECT avg(embedding[i]::DOUBLE) AS m, stddev_samp(embedding[i]::DOUBLE) AS s, i
              FROM embeddings, range(1, 65) t(i) GROUP BY i)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round((embedding[i]::DOUBLE - m) / s, 6) AS value
FROM embeddings, s""")
def standardise_embeddings(spark, sf_dir):
    names = [f"x{i}" for i in range(64)]
    vectors = prepare.vector_from_array(table(spark, sf_dir, "embeddings"), "embedding")
    wide = prepare.expand_vector(vectors.select("vec_id", "features"), "features", names)
    scaled = scaling.apply_scaler(wide, scaling.fit_scaler(wide, names))
    return reshape.to_long(scaled, ["vec_id"], names).select(
        "vec_id", "pos", F.round("value", 6).alias("value"))


@check(f"""WITH {FX_SQL} UNPIVOT (SELECT id, l_quantity, l_extendedprice, l_discount, l_tax FROM fx)
           ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value""")
def wide_to_long(spark, sf_dir):
    return reshape.to_long(fx(spark, sf_dir), ["id"], FX_FEATURES).drop("pos")


@check("""SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN n END) AS BIGINT) AS "A",
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN n END) AS BIGINT) AS "N",
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN n END) AS BIGINT) AS "R"
  FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey""")
def long_to_wide(spark, sf_dir):
    counts = (table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag")
              .agg(F.count("*").alias("n")))
    return reshape.to_wide(counts, ["l_suppkey"], "l_returnflag", "n", ["A", "N", "R"])


@check(f"""WITH {RN_SQL} SELECT run_id, experiment, start_time::DATE AS day, custkey FROM rn
           WHERE experiment = 'training'
           UNION ALL SELECT run_id, experiment, start_time::DATE AS day, NULL FROM rn
           WHERE experiment = 'preparation'""")
def append_rows(spark, sf_dir):
    runs = rn(spark, sf_dir).select("run_id", "experiment", F.to_date("start_time").alias("day"),
                                    C.map_default("params", "custkey", "").alias("custkey"))
    return reshape.append_rows(runs.where("experiment = 'training'"),
                               runs.where("experiment = 'preparation'").drop("custkey"))


@check(f"WITH {FX_SQL} SELECT id, l_quantity, 0.5 * l_tax AS l_tax, y AS extra FROM fx")
def merge_maps(spark, sf_dir):
    base = F.create_map(F.lit("l_quantity"), F.col("l_quantity"), F.lit("l_tax"), F.col("l_tax"))
    over = F.create_map(F.lit("l_tax"), F.col("l_tax") * 0.5, F.lit("extra"), F.col("y"))
    merged = scenario.override_map(
        fx(spark, sf_dir).select("id", base.alias("base"), over.alias("over")), "base", "over")
    return merged.select("id", *[F.col("merged")[k].alias(k) for k in ("l_quantity", "l_tax", "extra")])


@check(f"WITH {FX_SQL} SELECT id, l_quantity AS first, l_tax AS last, 4 AS n FROM fx")
def named_values(spark, sf_dir):
    values = fx(spark, sf_dir).select("id", F.array(*FX_FEATURES).alias("values"))
    named = reshape.named_values(values, FX_FEATURES, "values", "named")
    return named.select("id", F.col("named")["l_quantity"].alias("first"),
                        F.col("named")["l_tax"].alias("last"), F.size("named").alias("n"))


@check(f"WITH {FX_SQL} SELECT id, l_quantity, coalesce(NULLIF(l_tax, 0.0), 5.0) AS l_tax, "
       "5.0::DOUBLE AS other FROM fx")
def features_from_map(spark, sf_dir):
    values = F.create_map(F.lit("l_quantity"), F.col("l_quantity"),
                          F.lit("l_tax"), F.nullif("l_tax", F.lit(0.0)))
    sent = fx(spark, sf_dir).select("id", values.alias("sent"))
    return prepare.features_from_map(sent, "sent", ["l_quantity", "l_tax", "other"]).drop("sent")
