"""Metrics, bands, links and batch scoring."""

from pyspark.sql import functions as F

from checks.register import check
from checks.tables import FX, FX1, FX_FEATURES, FX_SQL, SPLIT_SQL, fx, rn, RN_SQL, table
from riskspark.functions import columns as C
from riskspark.operators import evaluate, scoring
from riskspark.operators.models import LinearWeights, fit_model, linear_weights, weights_table
from riskspark.operators.split import hash_split
from riskspark.plans.scoring import score_requests, score_table

# Three simple predictors of y; metrics do not care where a prediction comes from.
PREDICTORS = {"price": "l_extendedprice / 110000", "discounted": "l_extendedprice * (1 - l_discount) / 105000",
              "quantity": "l_quantity / 100"}
PREDICTED_SQL = (f"{FX_SQL}, predicted AS (SELECT id, y, {SPLIT_SQL} AS split, "
                 + ", ".join(f"{e} AS {n}" for n, e in PREDICTORS.items()) + " FROM fx)")
METRICS_SQL = """round(1 - sum((y - {p}) ** 2) / (var_pop(y) * count(*)), 6) AS r2,
  round(sqrt(avg((y - {p}) ** 2)), 6) AS rmse, round(avg((y - {p}) ** 2), 6) AS mse,
  round(avg(abs(y - {p})), 6) AS mae"""
ALL_METRICS_SQL = " UNION ALL ".join(
    f"SELECT split, '{n}' AS model, {METRICS_SQL.format(p=n)} FROM predicted GROUP BY split"
    for n in PREDICTORS)


def predicted(spark, sf_dir):
    df = hash_split(fx(spark, sf_dir), "id", FX)
    return df.select("id", "y", "split", *[F.expr(e).alias(n) for n, e in PREDICTORS.items()])


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _metric(name):
    def query(spark, sf_dir):
        return predicted(spark, sf_dir).groupBy("split").agg(
            F.round(evaluate.metric(name, "y", "discounted"), 8).alias(name))
    return query


for _name, _sql in (("r2", "1 - sum((y - discounted) ** 2) / (var_pop(y) * count(*))"),
                    ("rmse", "sqrt(avg((y - discounted) ** 2))"),
                    ("mse", "avg((y - discounted) ** 2)"), ("mae", "avg(abs(y - discounted))")):
    check(f"WITH {PREDICTED_SQL} SELECT split, round({_sql}, 8) AS {_name} FROM predicted "
          "GROUP BY split", f"metric_{_name}")(_metric(_name))


@check(f"WITH {PREDICTED_SQL} SELECT split, {METRICS_SQL.format(p='price')} FROM predicted GROUP BY split")
def evaluate_by_split(spark, sf_dir):
    return rounded(evaluate.evaluate(predicted(spark, sf_dir), "y", "price", ["split"]),
                   *evaluate.METRICS)


@check(f"WITH {PREDICTED_SQL} {ALL_METRICS_SQL}")
def evaluate_models(spark, sf_dir):
    out = evaluate.evaluate_models(predicted(spark, sf_dir), "y", {n: n for n in PREDICTORS})
    return rounded(out, *evaluate.METRICS)


@check(f"""WITH {PREDICTED_SQL}, m AS ({ALL_METRICS_SQL})
SELECT model, {', '.join(
    f"round(max({n.split('_')[1].lower()}) FILTER (split = '{n.split('_')[0].lower()}'), 4) AS {n}"
    for n in evaluate.SCORE_NAMES)} FROM m GROUP BY model""")
def score_table_wide(spark, sf_dir):
    metrics = evaluate.evaluate_models(predicted(spark, sf_dir), "y", {n: n for n in PREDICTORS})
    return evaluate.rounded_scores(evaluate.score_table(metrics))


# A run's scores, derived from orders: both diagnosis limits and ties occur.
@check("""SELECT o_orderkey, train_r2, test_r2,
  CASE WHEN train_r2 - test_r2 > 0.1 THEN 'overfit' WHEN test_r2 < 0.7 THEN 'underfit'
       ELSE 'good' END AS fit_status,
  CASE WHEN train_r2 - test_r2 > 0.1 THEN train_r2 - test_r2 END AS overfit_gap
FROM (SELECT o_orderkey, (o_orderkey % 20) / 20.0::DOUBLE AS train_r2,
             (o_custkey % 20) / 20.0::DOUBLE AS test_r2 FROM orders)""")
def diagnose_fit(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(
        "o_orderkey", ((F.col("o_orderkey") % 20) / F.lit(20.0)).alias("train_r2"),
        ((F.col("o_custkey") % 20) / F.lit(20.0)).alias("test_r2"))
    return evaluate.diagnose(runs, "train_r2", "test_r2")


@check("""SELECT o_orderkey, o_totalprice - o_custkey AS gap,
                 round(o_totalprice / 7, 4) AS rounded FROM orders""")
def gap_and_round(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") - F.col("o_custkey")).alias("gap"),
        F.round(F.col("o_totalprice") / 7, 4).alias("rounded"))


BAND_SQL = """CASE WHEN {s} IS NULL THEN NULL WHEN {s} < 0.3 THEN 'LOW' WHEN {s} < 0.5 THEN 'MODERATE'
  WHEN {s} < 0.7 THEN 'HIGH' ELSE 'CRITICAL' END"""
ADVICE_SQL = """CASE WHEN {s} IS NULL THEN NULL
  WHEN {s} < 0.3 THEN 'Minimal flood risk. Normal monitoring advised.'
  WHEN {s} < 0.5 THEN 'Moderate risk. Precautionary measures recommended.'
  WHEN {s} < 0.7 THEN 'High risk. Activate flood preparedness protocols.'
  ELSE 'Critical risk. Immediate evacuation may be required.' END"""


@check(f"""WITH {FX_SQL}, s AS (SELECT id, CASE WHEN l_discount = 0.05 THEN 'NaN'::DOUBLE
             WHEN l_tax = 0 THEN NULL WHEN l_discount = 0.03 THEN l_quantity / 10 ELSE y END AS score FROM fx)
SELECT id, score, {BAND_SQL.format(s='score')} AS band, {ADVICE_SQL.format(s='score')} AS advice,
       CASE WHEN score IS NULL OR isnan(score) THEN NULL ELSE least(score * 100, 100.0) END AS percent
FROM s""")
def risk_bands(spark, sf_dir):
    score = (F.when(F.col("l_discount") == 0.05, F.lit(float("nan")))
             .when(F.col("l_tax") == 0, F.lit(None))
             .when(F.col("l_discount") == 0.03, F.col("l_quantity") / 10).otherwise(F.col("y")))
    out = scoring.with_bands(fx(spark, sf_dir).select("id", score.alias("score")), FX, "score")
    valid = F.col("score").isNotNull() & ~F.isnan("score")
    return out.withColumn("percent", F.when(valid, F.col("percent")))


@check(f"""WITH {FX_SQL} SELECT {BAND_SQL.format(s='y')} AS band, count(*) AS n_rows,
           round(avg(y), 6) AS avg_score FROM fx GROUP BY 1""")
def band_report(spark, sf_dir):
    banded = scoring.with_bands(fx(spark, sf_dir), FX, "y")
    return rounded(scoring.band_report(banded, "y"), "avg_score")


@check(f"""WITH {FX_SQL} SELECT id, round(1 / (1 + exp(-(y * 4 - 2))), 9) AS sigmoid,
           y AS identity, 1 / (1 + exp(l_extendedprice)) AS saturated FROM fx""")
def link_functions(spark, sf_dir):
    score = F.col("y") * 4 - 2
    return fx(spark, sf_dir).select(
        "id", F.round(C.link(score, "sigmoid"), 9).alias("sigmoid"),
        C.link("y", "identity").alias("identity"),
        C.link(-F.col("l_extendedprice"), "sigmoid").alias("saturated"))


@check(f"""WITH {FX_SQL} SELECT id, printf('%.4f', y) AS score, printf('%.1f', y * 100) AS pct,
           printf('%.6f', l_extendedprice) AS price FROM fx""")
def fixed_decimal_text(spark, sf_dir):
    return fx(spark, sf_dir).select(
        "id", C.fixed_text("y", 4).alias("score"), C.fixed_text(F.col("y") * 100, 1).alias("pct"),
        C.fixed_text("l_extendedprice", 6).alias("price"))


WEIGHTS = LinearWeights(FX_FEATURES, (0.001, 0.000008, -0.4, 0.3), 0.05)


@check(f"""WITH {FX_SQL} SELECT id, round(l_quantity * 0.001 + l_extendedprice * 0.000008
           - l_discount * 0.4 + l_tax * 0.3 + 0.05, 9) AS prediction FROM fx""")
def score_linear_columns(spark, sf_dir):
    out = scoring.score_linear(fx(spark, sf_dir), WEIGHTS)
    return out.select("id", F.round("prediction", 9).alias("prediction"))


VECTOR = [round(0.1 * (i % 7) - 0.25, 2) for i in range(64)]


@check("SELECT vec_id, round(1 / (1 + exp(-("
       + " + ".join(f"embedding[{i + 1}]::DOUBLE * {w}" for i, w in enumerate(VECTOR))
       + " + 0.5))), 9) AS prediction FROM embeddings")
def score_linear_array(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "values", F.col("embedding").cast("array<double>"))
    out = scoring.score_array(vectors, "values", VECTOR, 0.5, "sigmoid")
    return out.select("vec_id", F.round("prediction", 9).alias("prediction"))


LINE_SQL = f"""{FX_SQL}, tr AS (SELECT * FROM fx WHERE {SPLIT_SQL} = 'train'),
line AS (SELECT regr_slope(y, l_extendedprice) AS w, regr_intercept(y, l_extendedprice) AS b,
         avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM tr)"""


def line_model(spark, sf_dir):
    train = hash_split(fx(spark, sf_dir), "id", FX1).where("split = 'train'")
    return fit_model(train, FX1)


@check(f"""WITH {LINE_SQL} SELECT 0 AS pos, 'l_extendedprice' AS term, round(w * 1e6, 5) AS weight
           FROM line UNION ALL SELECT -1, 'intercept', round(b * 1e6, 3) FROM line""")
def linear_weights_table(spark, sf_dir):
    out = weights_table(spark, linear_weights(line_model(spark, sf_dir), FX1.features))
    micro = F.col("weight") * 1e6
    return out.withColumn("weight", F.when(F.col("pos") < 0, F.round(micro, 3))
                          .otherwise(F.round(micro, 5)))


def _scored(link, scaled):
    def query(spark, sf_dir):
        out = score_table(fx(spark, sf_dir), line_model(spark, sf_dir), FX1, link, scaled)
        # Raw values make scores in the ten thousands; keep as many digits as both sides share.
        places = 6 if scaled or link == "sigmoid" else 2
        return out.select("id", F.round("prediction", places).alias("prediction"))
    return query


for _link, _form in (("identity", "{x}"), ("sigmoid", "1 / (1 + exp(-({x})))")):
    check(f"WITH {LINE_SQL} SELECT id, round({_form.format(x='w * l_extendedprice + b')}, 6) "
          "AS prediction FROM fx, line", f"score_scaled_{_link}")(_scored(_link, True))
    check(f"WITH {LINE_SQL} SELECT id, round({_form.format(x='w * s * l_extendedprice + (b + w * m)')}"
          f", {2 if _link == 'identity' else 6}) AS prediction FROM fx, line", f"score_raw_{_link}")(_scored(_link, False))


@check(f"""WITH {LINE_SQL}, asked AS (SELECT id, CASE WHEN l_discount <> 0.05 THEN l_extendedprice END
    AS p FROM fx), scored AS (SELECT id, w * p + b AS s FROM asked, line WHERE p BETWEEN 2000 AND 100000)
SELECT id, round(s, 6) AS prediction, 1 AS features_used, 'success' AS status,
  {BAND_SQL.format(s='s')} AS band, {ADVICE_SQL.format(s='s')} AS advice,
  round(least(s * 100, 100.0), 6) AS percent FROM scored""")
def batch_score_requests(spark, sf_dir):
    asked = fx(spark, sf_dir).select("id", F.when(F.col("l_discount") != 0.05, F.col("l_extendedprice"))
                                     .alias("l_extendedprice"))
    good, _ = score_requests(asked, ["id"], line_model(spark, sf_dir), FX1, low=2000, high=100000)
    return rounded(good, "prediction", "percent")


@check(f"""WITH {FX_SQL} SELECT id, CASE WHEN l_discount = 0.05 THEN 'missing: l_extendedprice'
             ELSE 'out of range: l_extendedprice' END AS reason
           FROM fx WHERE l_discount = 0.05 OR NOT l_extendedprice BETWEEN 2000 AND 100000""")
def batch_score_rejects(spark, sf_dir):
    asked = fx(spark, sf_dir).select("id", F.when(F.col("l_discount") != 0.05, F.col("l_extendedprice"))
                                     .alias("l_extendedprice"))
    _, bad = score_requests(asked, ["id"], line_model(spark, sf_dir), FX1, low=2000, high=100000)
    return bad


@check(f"""WITH {RN_SQL} SELECT run_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS started,
  substr(repeat(run_name || '; ', 20), 1, 200) AS short, upper(run_name) AS loud,
  starts_with(run_name, '1-') AS urgent FROM rn""")
def text_functions(spark, sf_dir):
    return rn(spark, sf_dir).select(
        "run_id", C.timestamp_text("start_time").alias("started"),
        C.short_text(F.repeat(F.concat("run_name", F.lit("; ")), 20)).alias("short"),
        F.upper("run_name").alias("loud"), F.col("run_name").startswith("1-").alias("urgent"))


@check(f"""WITH {LINE_SQL}, p AS (SELECT w * l_extendedprice + b AS s FROM fx, line
             WHERE {SPLIT_SQL} = 'test')
SELECT {BAND_SQL.format(s='s')} AS band, count(*) AS n_rows, round(avg(s), 6) AS avg_score
FROM p GROUP BY 1""")
def held_out_bands(spark, sf_dir):
    """Split, scale, fit, score the held-out rows, band them: the whole job in one query."""
    test = hash_split(fx(spark, sf_dir), "id", FX1).where("split = 'test'")
    scored = score_table(test, line_model(spark, sf_dir), FX1)
    return rounded(scoring.band_report(scoring.with_bands(scored, FX1)), "avg_score")
