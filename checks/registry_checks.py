"""Run log, score history, champion pointer, model store."""

from pyspark.sql import functions as F

from checks.register import check
from checks.scoring_checks import LINE_SQL, line_model
from checks.tables import FX1, RN_SQL, fx, rn, table
from riskspark.operators import evaluate
from riskspark.plans.scoring import score_table
from riskspark.session import work_path
from riskspark.sources import runs as R


def _logged(spark, sf_dir):
    """The run log written and read back."""
    path = work_path(spark, "runs")
    R.append_runs(rn(spark, sf_dir), path)
    return R.read_runs(spark, path)


@check(f"""WITH {RN_SQL} SELECT run_id, experiment, run_name, epoch_us(start_time) AS start_us,
           best_model_name, custkey, best_rmse, status FROM rn""")
def run_log(spark, sf_dir):
    return _logged(spark, sf_dir).select(
        "run_id", "experiment", "run_name", F.unix_micros("start_time").alias("start_us"),
        F.col("params")["best_model_name"].alias("best_model_name"),
        F.col("params")["custkey"].alias("custkey"), F.col("metrics")["best_RMSE"].alias("best_rmse"),
        F.col("tags")["status"].alias("status"))


@check(f"""WITH {RN_SQL} SELECT run_id, 'best_model_name' AS name, best_model_name AS value FROM rn
           UNION ALL SELECT run_id, 'custkey', custkey FROM rn""")
def run_params_long(spark, sf_dir):
    return R.map_rows(rn(spark, sf_dir), "params")


@check(f"WITH {RN_SQL} SELECT run_id, run_name FROM rn WHERE experiment = 'preparation' AND status = 'success'")
def successful_runs(spark, sf_dir):
    return R.successful_runs(_logged(spark, sf_dir), "preparation").select("run_id", "run_name")


@check(f"""WITH {RN_SQL} SELECT run_id, run_name FROM rn WHERE experiment = 'preparation'
           AND status = 'success' ORDER BY start_time DESC, run_id DESC LIMIT 1""")
def latest_run(spark, sf_dir):
    return R.latest_run(R.successful_runs(rn(spark, sf_dir), "preparation")).select("run_id", "run_name")


@check(f"""WITH {RN_SQL} SELECT experiment, run_name, run_id FROM rn
  QUALIFY row_number() OVER (PARTITION BY experiment, run_name ORDER BY start_time DESC, run_id DESC) = 1""")
def latest_run_per_name(spark, sf_dir):
    return R.latest_run_per(rn(spark, sf_dir), ["experiment", "run_name"])


@check(f"""WITH {RN_SQL}, prep AS (SELECT custkey, start_time, max(run_id) AS prep_id FROM rn
             WHERE experiment = 'preparation' AND status = 'success' GROUP BY ALL)
SELECT t.run_id, t.custkey, prep_id AS preprocessing_run_id
FROM (SELECT * FROM rn WHERE experiment = 'training') t
ASOF LEFT JOIN prep ON t.custkey = prep.custkey AND t.start_time >= prep.start_time""")
def lineage_per_customer(spark, sf_dir):
    runs = rn(spark, sf_dir).withColumn("custkey", F.col("params")["custkey"])
    train = runs.where("experiment = 'training'").select("custkey", "start_time", "run_id")
    out = R.lineage(train, R.successful_runs(runs, "preparation"), ["custkey"])
    return out.select("run_id", "custkey", "preprocessing_run_id")


@check(f"""WITH {RN_SQL}, prep AS (SELECT start_time, max(run_id) AS prep_id FROM rn
             WHERE experiment = 'preparation' AND status = 'success' GROUP BY ALL)
SELECT t.run_id, prep_id AS preprocessing_run_id
FROM (SELECT * FROM rn WHERE experiment = 'training') t
ASOF LEFT JOIN prep ON t.start_time >= prep.start_time""")
def lineage(spark, sf_dir):
    """One experiment for all: a single key, spread over the slices."""
    runs = rn(spark, sf_dir)
    train = runs.where("experiment = 'training'").select("start_time", "run_id")
    out = R.lineage(train, R.successful_runs(runs, "preparation"), [])
    return out.select("run_id", "preprocessing_run_id")


@check(f"""WITH {RN_SQL}, pointers AS (SELECT CAST(l_orderkey * 2 AS VARCHAR) AS run_id, count(*) AS n
             FROM lineitem GROUP BY 1)
SELECT p.run_id, n, coalesce(best_model_name, 'UnknownModel') AS algorithm,
       coalesce(best_rmse, 0.0) AS best_rmse FROM pointers p LEFT JOIN rn USING (run_id)""")
def run_details(spark, sf_dir):
    pointers = (table(spark, sf_dir, "lineitem")
                .groupBy((F.col("l_orderkey") * 2).cast("string").alias("run_id"))
                .agg(F.count("*").alias("n")))
    return R.with_run_details(pointers, rn(spark, sf_dir))


# Scores with ties and unusable values, ordered by an explicit ordinal.
CANDIDATES_SQL = """candidates AS (SELECT o_orderstatus AS experiment, CAST(o_orderkey AS INTEGER) AS ordinal,
  o_orderpriority AS model, CASE WHEN o_orderkey % 13 = 0 THEN 'NaN'::DOUBLE
    ELSE round(o_totalprice / 5000) END AS score FROM orders)"""


def _candidates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("experiment"), F.col("o_orderkey").cast("int").alias("ordinal"),
        F.col("o_orderpriority").alias("model"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(float("nan")))
        .otherwise(F.round(F.col("o_totalprice") / 5000)).alias("score"))


@check(f"""WITH {CANDIDATES_SQL} SELECT experiment, model, ordinal, score FROM candidates
  WHERE NOT isnan(score) QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY score, ordinal) = 1""")
def champion(spark, sf_dir):
    return evaluate.champion(_candidates(spark, sf_dir), ["experiment"], "score")


@check(f"""WITH {CANDIDATES_SQL}, b AS (SELECT *, min(CASE WHEN NOT isnan(score) THEN score END) OVER
    (PARTITION BY experiment ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS best_before FROM candidates)
SELECT experiment, ordinal, best_before,
  NOT isnan(score) AND (best_before IS NULL OR score < best_before) AS new_best FROM b""")
def new_best_events(spark, sf_dir):
    out = evaluate.new_best_events(_candidates(spark, sf_dir), ["experiment"], ["ordinal"], "score")
    return out.select("experiment", "ordinal", "best_before", "new_best")


def _scores(spark, sf_dir):
    """Eight figures per priority from orders, as if each priority were a model."""
    price = F.col("o_totalprice") / 1e6
    return (table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("model"))
            .agg(*[F.min(price + i / 8).alias(n) for i, n in enumerate(evaluate.SCORE_NAMES)]))


SCORES_SQL = ("SELECT o_orderpriority AS model, " + ", ".join(
    f"round(min(o_totalprice / 1e6 + {i / 8}), 4) AS {n}" for i, n in enumerate(evaluate.SCORE_NAMES))
    + " FROM orders GROUP BY 1")


@check(f"""WITH s AS ({SCORES_SQL}) SELECT r.run AS run_timestamp, 'id-' || r.run AS best_run_id,
           '1-URGENT' AS best_model, s.* FROM s, (VALUES ('monday'), ('tuesday')) r(run)""")
def score_history(spark, sf_dir):
    path = work_path(spark, "scores")
    for run in ("monday", "tuesday"):
        R.append_scores(R.score_record(_scores(spark, sf_dir), run, "1-URGENT", f"id-{run}", 0.25), path)
    return R.flat_scores(R.read_scores(spark, path))


@check("SELECT count(DISTINCT o_orderpriority) AS n_runs FROM orders")
def history_length(spark, sf_dir):
    """One record per priority is appended in a single write."""
    path = work_path(spark, "scores")
    name = F.col("o_orderpriority")
    records = table(spark, sf_dir, "orders").groupBy(name.alias("best_model")).agg(
        F.lit("monday").alias("run_timestamp"), F.max("o_totalprice").alias("best_rmse"))
    R.append_scores(records, path)
    return R.history_length(R.read_scores(spark, path))


@check("SELECT CAST(arg_min(o_orderkey, o_totalprice) AS VARCHAR) AS run_id FROM orders")
def champion_pointer(spark, sf_dir):
    path = work_path(spark, "champion")
    best = table(spark, sf_dir, "orders").agg(F.min_by("o_orderkey", "o_totalprice").alias("k"))
    R.write_champion(best.select(F.concat(F.lit("  "), F.col("k").cast("string"), F.lit(" \n"))
                                 .alias("run_id")), path)
    run_id = R.read_champion(spark, path)
    return table(spark, sf_dir, "orders").where(F.col("o_orderkey").cast("string") == run_id).select(
        F.lit(run_id).alias("run_id"))


def _registry(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("version"),
        F.concat(F.when(F.col("o_orderkey") % 3 == 0, "best_model_v_store/best_model_latest")
                 .otherwise("best_model_v_store/best_model_v"), F.col("o_custkey").cast("string")).alias("versioned_path"))


@check("""SELECT count(*) AS n_versions, CAST(coalesce(max(o_custkey), 0) + 1 AS INTEGER) AS next_version
          FROM orders WHERE o_orderkey % 3 <> 0""")
def model_versions(spark, sf_dir):
    return R.versions(_registry(spark, sf_dir))


@check("""SELECT 'best_model_v' || o_custkey AS name, count(*) AS n FROM orders
          WHERE o_orderkey % 3 <> 0 GROUP BY 1""")
def versioned_names(spark, sf_dir):
    names = _registry(spark, sf_dir).select(F.substring_index("versioned_path", "/", -1).alias("name"))
    return R.versioned_names(names).groupBy("name").agg(F.count("*").alias("n"))


PREDICTED_SQL = "SELECT id, round(w * l_extendedprice + b, 6) AS prediction FROM fx, line"


@check(f"WITH {LINE_SQL} {PREDICTED_SQL}")
def saved_model_scores(spark, sf_dir):
    """Save, load and score; equal to scoring with the closed form."""
    path = work_path(spark, "model")
    R.save_model(line_model(spark, sf_dir), path)
    model = R.load_model(spark, path)
    return model.transform(fx(spark, sf_dir)).select("id", F.round("prediction", 6).alias("prediction"))


@check(f"WITH {LINE_SQL} {PREDICTED_SQL}")
def run_artifact_scores(spark, sf_dir):
    """The model logged with a run is found through the run's parameters."""
    root = work_path(spark, "job")
    path = R.log_model(line_model(spark, sf_dir), root, "run-1")
    R.log_run(spark, f"{root}/runs", "Training", "line", {"artifact": path}, run_id="run-1")
    logged = R.read_runs(spark, f"{root}/runs").where("run_id = 'run-1'").first()
    model = R.load_model(spark, logged["params"]["artifact"])
    return score_table(fx(spark, sf_dir), model, FX1).select(
        "id", F.round("prediction", 6).alias("prediction"))


@check(f"""WITH {LINE_SQL}, e AS (SELECT round(sqrt(avg((y - (w * l_extendedprice + b)) ** 2)), 6) AS rmse
             FROM fx, line)
SELECT version, 'line_model' AS model_name, 'LinearRegression' AS algorithm, 'run-1' AS run_id, rmse AS best_rmse,
  'best_model_v' || version AS versioned, 'best_model_latest' AS latest FROM e, (VALUES (1), (2)) v(version)""")
def promotion_record(spark, sf_dir):
    store = work_path(spark, "models")
    model = line_model(spark, sf_dir)
    rmse = evaluate.evaluate(model.transform(fx(spark, sf_dir)), "y", "prediction").first()["rmse"]
    for _ in range(2):
        R.promote(spark, model, store, "run-1", "LinearRegression", round(rmse, 6), "line_model")
    return R.read_registry(spark, f"{store}/registry").select(
        "version", "model_name", "algorithm", "run_id", "best_rmse",
        F.substring_index("versioned_path", "/", -1).alias("versioned"),
        F.substring_index("latest_path", "/", -1).alias("latest"))
