"""Training. With one feature every linear fit has a closed form, and a tree of one split too."""

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks.register import check
from checks.tables import FOLD_SQL, FX, FX1, FX_SQL, RX_SQL, SPLIT_SQL, fx, rx
from riskspark.operators import evaluate, models, scaling
from riskspark.operators.prepare import assemble
from riskspark.operators.split import assign_folds, hash_split
from riskspark.plans.scoring import score_table
from riskspark.plans.training import tournament
from riskspark.spec import REGIONAL

GRID = FX1.grid_points("LinearRegression")
GRID_SQL = ("grid AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {p['regParam']}::DOUBLE, {p['elasticNetParam']}::DOUBLE)" for i, p in enumerate(GRID))
    + ") g(grid_id, reg, alpha))")
# Slope and intercept of the one-feature elastic net; the penalty is relative to the target's std.
FIT_SQL = """sign(r) * greatest(abs(r) - alpha * reg / sy, 0) / (1 + (1 - alpha) * reg / sy) * sy / sx"""
MOMENTS_SQL = """corr(y, x) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my"""
TRAIN_SQL = f"""{FX_SQL}, {GRID_SQL}, tr AS (SELECT id, l_extendedprice AS x, y, {FOLD_SQL} AS fold
  FROM fx WHERE {SPLIT_SQL} = 'train')"""
CV_SQL = f"""{TRAIN_SQL}, m AS (SELECT k.fold, {MOMENTS_SQL} FROM tr, (SELECT DISTINCT fold FROM tr) k
    WHERE tr.fold <> k.fold GROUP BY k.fold),
fit AS (SELECT fold, grid_id, reg, alpha, mx, my, {FIT_SQL} AS w FROM m, grid),
errors AS (SELECT fit.fold, grid_id, reg, alpha, sqrt(avg((y - (my + w * (x - mx))) ** 2)) AS rmse
    FROM tr JOIN fit USING (fold) GROUP BY ALL),
cv AS (SELECT grid_id, reg, alpha, avg(rmse) AS avg_rmse FROM errors GROUP BY ALL)"""


def train_rows(spark, sf_dir, spec=FX1):
    df = assign_folds(hash_split(fx(spark, sf_dir), "id", spec), "id", spec)
    return df.where("split = 'train'")


def scaled_rows(spark, sf_dir, spec=FX1):
    train = train_rows(spark, sf_dir, spec)
    return scaling.apply_scaler(train, scaling.fit_scaler(train, spec.features))


@check(f"""WITH {TRAIN_SQL}, m AS (SELECT {MOMENTS_SQL} FROM tr)
SELECT grid_id, reg, alpha, round(1e6 * w, 4) AS slope, round(my - w * mx, 6) AS intercept
FROM (SELECT *, {FIT_SQL} AS w FROM m, grid)""")
def elastic_net_fits(spark, sf_dir):
    train = assemble(train_rows(spark, sf_dir), FX1.features).select("features", "y").persist()
    rows = []
    for i, point in enumerate(GRID):
        fit = models.make_estimator("LinearRegression", FX1, point).fit(train)
        rows.append((i, point["regParam"], point["elasticNetParam"],
                     float(fit.coefficients[0]) * 1e6, float(fit.intercept)))
    train.unpersist()
    out = spark.createDataFrame(rows, "grid_id int, reg double, alpha double, slope double, intercept double")
    return out.select("grid_id", "reg", "alpha", F.round("slope", 4).alias("slope"),
                      F.round("intercept", 6).alias("intercept"))


def _scaled_search(spark, sf_dir):
    """The linear grid on standardised rows, as the tournament searches it."""
    train = assemble(scaled_rows(spark, sf_dir), FX1.features).select("features", "y", "fold").persist()
    try:
        return models.grid_search(train, "LinearRegression", FX1)
    finally:
        train.unpersist()


def _search_rows(spark, result):
    return result.table(spark).select(
        "grid_id", F.col("params")["regParam"].alias("reg"),
        F.col("params")["elasticNetParam"].alias("alpha"), F.round("avg_rmse", 8).alias("avg_rmse"))


@check(f"WITH {CV_SQL} SELECT grid_id, reg, alpha, round(avg_rmse, 8) AS avg_rmse FROM cv")
def grid_search(spark, sf_dir):
    train = assemble(train_rows(spark, sf_dir), FX1.features).select("features", "y", "fold").persist()
    result = models.grid_search(train, "LinearRegression", FX1)
    train.unpersist()
    return _search_rows(spark, result)


@check(f"WITH {CV_SQL} SELECT grid_id, reg, alpha, round(avg_rmse, 8) AS avg_rmse FROM cv")
def linear_grid_search(spark, sf_dir):
    return _search_rows(spark, _scaled_search(spark, sf_dir))


@check(f"""WITH {CV_SQL} SELECT arg_min(grid_id, avg_rmse * 1e9 + grid_id) AS grid_id,
                                round(min(avg_rmse), 8) AS avg_rmse FROM cv""")
def best_grid_point(spark, sf_dir):
    result = _scaled_search(spark, sf_dir)
    best = evaluate.best_grid_point(result.table(spark))
    return best.select("grid_id", F.round("avg_rmse", 8).alias("avg_rmse"))


@check(f"""WITH {CV_SQL}, best AS (SELECT * FROM cv ORDER BY avg_rmse, grid_id LIMIT 1)
SELECT 'LinearRegression' AS model, 'regParam' AS name, reg AS value FROM best
UNION ALL SELECT 'LinearRegression', 'elasticNetParam', alpha FROM best""")
def best_params(spark, sf_dir):
    result = _scaled_search(spark, sf_dir)
    return models.best_params_table(spark, result)


@check(f"""WITH {FX_SQL}, {GRID_SQL}, sizes AS (SELECT {FOLD_SQL} AS fold, count(*) AS n FROM fx
             WHERE {SPLIT_SQL} = 'train' GROUP BY 1)
SELECT grid_id, reg, alpha, fold, n AS validation_rows,
       CAST(sum(n) OVER (PARTITION BY grid_id) - n AS BIGINT) AS training_rows FROM grid, sizes""")
def parameter_grid(spark, sf_dir):
    """Every fit of the linear search: grid point x fold, with the rows it sees."""
    sizes = train_rows(spark, sf_dir).groupBy("fold").agg(F.count("*").alias("n"))
    grid = models.grid_table(spark, FX1).where("model = 'LinearRegression'")
    points = F.broadcast(grid.select("grid_id", F.col("params")["regParam"].alias("reg"),
                                     F.col("params")["elasticNetParam"].alias("alpha"),
                                     F.explode(F.sequence(F.lit(0), F.lit(FX1.folds - 1))).alias("fold")))
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.join(points, "fold").select(
        "grid_id", "reg", "alpha", "fold", F.col("n").alias("validation_rows"),
        (total - F.col("n")).alias("training_rows"))


@check(f"""WITH {FX_SQL}, line AS (SELECT regr_slope(y, l_extendedprice) AS w,
             regr_intercept(y, l_extendedprice) AS b FROM fx WHERE {SPLIT_SQL} = 'train'),
p AS (SELECT {SPLIT_SQL} AS split, y, w * l_extendedprice + b AS p FROM fx, line)
SELECT split, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 8) AS r2,
  round(sqrt(avg((y - p) ** 2)), 8) AS rmse, round(avg((y - p) ** 2), 8) AS mse,
  round(avg(abs(y - p)), 8) AS mae FROM p GROUP BY split""")
def predict_both_splits(spark, sf_dir):
    df = hash_split(fx(spark, sf_dir), "id", FX1)
    model = models.fit_model(df.where("split = 'train'"), FX1)
    scored = evaluate.evaluate(model.transform(df), "y", "prediction", ["split"])
    return scored.select("split", *[F.round(m, 8).alias(m) for m in evaluate.METRICS])


# ---- trees: the best single split over discount and tax -------------------------------------

STUMP_FEATURES = ["l_discount", "l_tax"]


def _stump_sql(source: str, target: str, name: str) -> str:
    """Best split of ``source`` on ``target`` by variance: feature, threshold, both means."""
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS v, count(*) AS n, sum({target}) AS s FROM {source} "
        f"GROUP BY {f}" for f in STUMP_FEATURES)
    return f"""{name}_v AS ({parts}),
{name}_c AS (SELECT feature, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
    sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
    FROM {name}_v WINDOW w AS (PARTITION BY feature ORDER BY v)),
{name} AS (SELECT feature, v, sl / nl AS below, (s - sl) / (n - nl) AS above FROM {name}_c
    WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, feature LIMIT 1)"""


STUMP_P = "CASE WHEN CASE {t}.feature WHEN 'l_discount' THEN l_discount ELSE l_tax END <= {t}.v THEN {t}.below ELSE {t}.above END"
STUMP_SQL = f"""{FX_SQL}, sp AS (SELECT *, {SPLIT_SQL} AS split FROM fx),
tr AS (SELECT * FROM sp WHERE split = 'train'), {_stump_sql('tr', 'y', 't1')}"""


def _tree_scores(spark, sf_dir, name, params):
    df = hash_split(fx(spark, sf_dir), "id", FX)
    spec = replace(FX, features=tuple(STUMP_FEATURES))
    stages = [VectorAssembler(inputCols=STUMP_FEATURES, outputCol="features"),
              models.make_estimator(name, spec, params)]
    model = Pipeline(stages=stages).fit(df.where("split = 'train'"))
    return model.transform(df).groupBy("split", F.round("prediction", 8).alias("prediction")).agg(
        F.count("*").alias("n_rows"), F.round(F.avg("y"), 8).alias("avg_y"))


_ONE_SPLIT = (f"WITH {STUMP_SQL} SELECT split, round({STUMP_P.format(t='t1')}, 8) AS prediction, "
              "count(*) AS n_rows, round(avg(y), 8) AS avg_y FROM sp, t1 GROUP BY 1, 2")


@check(_ONE_SPLIT)
def decision_tree_split(spark, sf_dir):
    return _tree_scores(spark, sf_dir, "DecisionTreeRegressor", {"maxDepth": 1})


@check(_ONE_SPLIT)
def random_forest_one_tree(spark, sf_dir):
    return _tree_scores(spark, sf_dir, "RandomForestRegressor",
                        {"maxDepth": 1, "numTrees": 1, "bootstrap": False})


@check(f"""WITH {STUMP_SQL}, r1 AS (SELECT tr.*, 2 * (y - {STUMP_P.format(t='t1')}) AS residual FROM tr, t1),
{_stump_sql('r1', 'residual', 't2')}
SELECT split, round({STUMP_P.format(t='t1')} + 0.1 * {STUMP_P.format(t='t2')}, 8) AS prediction,
  count(*) AS n_rows, round(avg(y), 8) AS avg_y FROM sp, t1, t2 GROUP BY 1, 2""")
def boosted_two_rounds(spark, sf_dir):
    return _tree_scores(spark, sf_dir, "GradientBoostingRegressor",
                        {"maxDepth": 1, "maxIter": 2, "stepSize": 0.1})


# All four models on one feature, so that SQL can follow the whole tournament: the linear grid
# is searched in full, the trees make one split each and the boosted model two.
ONE_FEATURE = replace(FX, features=("l_discount",), grids={
    "LinearRegression": {"regParam": (0.01, 0.1), "elasticNetParam": (0.0, 0.5, 1.0)},
    "DecisionTreeRegressor": {"maxDepth": (1,)},
    "RandomForestRegressor": {"numTrees": (1,), "maxDepth": (1,), "bootstrap": (False,)},
    "GradientBoostingRegressor": {"maxDepth": (1,), "maxIter": (2,)}})


def _split_at(source: str, target: str, name: str) -> str:
    return f"""{name}_v AS (SELECT l_discount AS v, count(*) AS n, sum({target}) AS s FROM {source} GROUP BY 1),
{name}_c AS (SELECT v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s
    FROM {name}_v WINDOW w AS (ORDER BY v)),
{name} AS (SELECT v, sl / nl AS below, (s - sl) / (n - nl) AS above FROM {name}_c
    WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)"""


_AT = "CASE WHEN l_discount <= {t}.v THEN {t}.below ELSE {t}.above END"
TOURNAMENT_SQL = f"""{CV_SQL.replace("l_extendedprice AS x", "l_discount AS x, l_discount")},
pick AS (SELECT * FROM cv ORDER BY avg_rmse, grid_id LIMIT 1),
whole AS (SELECT {MOMENTS_SQL} FROM tr),
line AS (SELECT my, mx, {FIT_SQL} AS w FROM whole, pick),
{_split_at('tr', 'y', 't1')},
r1 AS (SELECT tr.*, 2 * (y - {_AT.format(t='t1')}) AS residual FROM tr, t1),
{_split_at('r1', 'residual', 't2')},
p AS (SELECT {SPLIT_SQL} AS split, y, my + w * (l_discount - mx) AS linear, {_AT.format(t='t1')} AS tree,
    {_AT.format(t='t1')} + 0.1 * {_AT.format(t='t2')} AS boosted FROM fx, line, t1, t2),
long AS (SELECT split, y, unnest([
    {{'model': 'LinearRegression', 'ordinal': 0, 'p': linear}},
    {{'model': 'DecisionTreeRegressor', 'ordinal': 1, 'p': tree}},
    {{'model': 'RandomForestRegressor', 'ordinal': 2, 'p': tree}},
    {{'model': 'GradientBoostingRegressor', 'ordinal': 3, 'p': boosted}}], recursive := true) FROM p),
e AS (SELECT model, ordinal, split, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2,
    sqrt(avg((y - p) ** 2)) AS rmse, avg((y - p) ** 2) AS mse, avg(abs(y - p)) AS mae FROM long GROUP BY ALL),
s AS (SELECT model, CAST(ordinal AS INTEGER) AS ordinal, {', '.join(
    f"max({n.split('_')[1].lower()}) FILTER (split = '{n.split('_')[0].lower()}') AS {n}"
    for n in evaluate.SCORE_NAMES)} FROM e GROUP BY ALL)"""


def _one_feature_tournament(spark, sf_dir):
    spec = ONE_FEATURE
    df = assign_folds(hash_split(fx(spark, sf_dir), "id", spec), "id", spec)
    scaler = scaling.fit_scaler(df.where("split = 'train'"), spec.features)
    return tournament(scaling.apply_scaler(df, scaler).select(*spec.kept, "split", "fold"), spec)


@check(f"""WITH {TOURNAMENT_SQL} SELECT model, ordinal, {', '.join(
    f"round({n}, 7) AS {n}" for n in evaluate.SCORE_NAMES)},
  CASE WHEN Train_R2 - Test_R2 > 0.1 THEN 'overfit' WHEN Test_R2 < 0.7 THEN 'underfit'
       ELSE 'good' END AS fit_status FROM s""")
def tournament_scores(spark, sf_dir):
    scores = _one_feature_tournament(spark, sf_dir).scores
    return scores.select("model", "ordinal", "fit_status",
                         *[F.round(n, 7).alias(n) for n in evaluate.SCORE_NAMES])


@check(f"""WITH {TOURNAMENT_SQL} SELECT model, ordinal, round(Test_RMSE, 7) AS Test_RMSE FROM s
           ORDER BY round(s.Test_RMSE, 12), ordinal LIMIT 1""")
def tournament_champion(spark, sf_dir):
    scores = _one_feature_tournament(spark, sf_dir).scores
    best = evaluate.champion(scores)
    return best.withColumn("Test_RMSE", F.round("Test_RMSE", 7))


SMALL_GRIDS = {"LinearRegression": {"regParam": (0.01, 0.1), "elasticNetParam": (0.0, 0.5, 1.0)},
               "DecisionTreeRegressor": {"maxDepth": (2, 4)},
               "RandomForestRegressor": {"numTrees": (3,), "maxDepth": (3,)},
               "GradientBoostingRegressor": {"maxDepth": (2,), "maxIter": (3,)}}
REGIONAL_SMALL = replace(REGIONAL, grids=SMALL_GRIDS)


@check(f"""WITH {RX_SQL}, v AS (SELECT {', '.join(
    f"var_pop({REGIONAL.target}) FILTER (split = '{s}') AS {s}_variance" for s in ("train", "test"))}
  FROM (SELECT *, {SPLIT_SQL} AS split FROM rx))
SELECT model, CAST(ordinal AS INTEGER) AS ordinal, n_points, true AS squares_agree,
  true AS best_point_first, true AS beats_the_mean, true AS champion_agrees,
  round(train_variance, 7) AS train_variance, round(test_variance, 7) AS test_variance
FROM v, (VALUES {', '.join(f"('{m}', {i}, {len(REGIONAL_SMALL.grid_points(m))}::BIGINT)"
                           for i, m in enumerate(SMALL_GRIDS))}) m(model, ordinal, n_points)""")
def model_tournament(spark, sf_dir):
    """All four models with small grids on the 17-feature table: what must hold of their scores.

    SQL cannot fit the forests, but it knows the variance that each R2 is measured against.
    """
    spec = REGIONAL_SMALL
    df = assign_folds(hash_split(rx(spark, sf_dir), "id", spec), "id", spec)
    scaler = scaling.fit_scaler(df.where("split = 'train'"), spec.features)
    rows = scaling.apply_scaler(df, scaler).select(*spec.kept, "split", "fold")
    result = tournament(rows, spec)
    lowest = min(result.scores.collect(), key=lambda r: (round(r["Test_RMSE"], 12), r["ordinal"]))
    best = evaluate.champion(result.scores).first()
    searches = spark.createDataFrame(
        [(m, len(r.points), min(r.avg_rmse) == r.avg_rmse[r.best]) for m, r in result.searches.items()],
        "model string, n_points long, best_point_first boolean")

    def near(left, right):
        return F.abs(left - right) < 1e-9

    return result.scores.join(searches, "model").select(
        "model", "ordinal", "n_points", "best_point_first",
        (near(F.col("Train_RMSE") ** 2, F.col("Train_MSE"))
         & near(F.col("Test_RMSE") ** 2, F.col("Test_MSE"))).alias("squares_agree"),
        (F.col("Test_R2") > 0).alias("beats_the_mean"),
        F.lit(best["model"] == lowest["model"]).alias("champion_agrees"),
        F.round(F.col("Train_MSE") / (1 - F.col("Train_R2")), 7).alias("train_variance"),
        F.round(F.col("Test_MSE") / (1 - F.col("Test_R2")), 7).alias("test_variance"))


@check(f"""WITH {STUMP_SQL} SELECT pos, f.feature, CASE WHEN f.feature = t1.feature THEN 1.0::DOUBLE
           ELSE 0.0::DOUBLE END AS importance FROM (VALUES (0, 'l_discount'), (1, 'l_tax')) f(pos, feature), t1""")
def tree_importances(spark, sf_dir):
    spec = replace(FX, features=tuple(STUMP_FEATURES))
    train = train_rows(spark, sf_dir, spec)
    model = models.fit_model(train, spec, "DecisionTreeRegressor", {"maxDepth": 1})
    return models.importance_table(spark, model, spec.features)


@check(f"""WITH {STUMP_SQL}, r1 AS (SELECT tr.*, 2 * (y - {STUMP_P.format(t='t1')}) AS residual FROM tr, t1),
{_stump_sql('r1', 'residual', 't2')}
SELECT id, round({STUMP_P.format(t='t1')} + 0.1 * {STUMP_P.format(t='t2')}, 8) AS prediction FROM fx, t1, t2""")
def score_with_trees(spark, sf_dir):
    """A boosted model behind its scaler, scored over the whole table."""
    spec = replace(FX, features=tuple(STUMP_FEATURES))
    model = models.fit_model(train_rows(spark, sf_dir, spec), spec, "GradientBoostingRegressor",
                             {"maxDepth": 1, "maxIter": 2})
    out = score_table(fx(spark, sf_dir), model, spec)
    return out.select("id", F.round("prediction", 8).alias("prediction"))


# ---- whole trees: every split of every level, searched in SQL ---------------------------------

DEEP = replace(FX, features=("l_quantity", "l_discount", "l_tax"))
BINS = {"maxBins": 64}  # more than distinct values, so every value is a candidate


def grown_sql(source: str, target: str, name: str, depth: int) -> str:
    """A regression tree over ``DEEP``: level by level the best split by variance of each node.

    Makes ``{name}`` (all columns of ``source``, its leaf and ``{name}_p``) and ``{name}_g`` (node,
    feature, gained: variance times rows that the split takes away). Training rows decide.
    """
    steps = [f"{name}_0 AS (SELECT *, 1 AS {name}_n FROM {source})"]
    for level in range(depth):
        at = f"{name}_{level}"
        values = " UNION ALL ".join(
            f"SELECT {name}_n AS node, {pos} AS pos, '{f}' AS feature, CAST({f} AS DOUBLE) AS v, count(*) AS n, "
            f"sum({target}) AS s FROM {at} WHERE split = 'train' GROUP BY ALL" for pos, f in enumerate(DEEP.features))
        steps += [
            f"{at}_v AS ({values})",
            f"""{at}_c AS (SELECT *, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER k AS nt, sum(s) OVER k AS st
  FROM {at}_v WINDOW w AS (PARTITION BY node, feature ORDER BY v), k AS (PARTITION BY node, feature))""",
            f"""{at}_b AS (SELECT node, feature, v, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gained
  FROM {at}_c WHERE nl < nt QUALIFY row_number() OVER (PARTITION BY node ORDER BY gained DESC, pos, v) = 1)""",
            f"""{name}_{level + 1} AS (SELECT {at}.* REPLACE (CASE WHEN feature IS NULL THEN {name}_n
  WHEN CASE feature {' '.join(f"WHEN '{f}' THEN {f}" for f in DEEP.features)} END <= v THEN 2 * {name}_n
  ELSE 2 * {name}_n + 1 END AS {name}_n) FROM {at} LEFT JOIN {at}_b ON node = {name}_n)"""]
    last = f"{name}_{depth}"
    steps += [f"{name}_l AS (SELECT {name}_n AS leaf, avg({target}) AS {name}_p FROM {last} WHERE split = 'train' GROUP BY 1)",
              f"{name} AS (SELECT {last}.*, {name}_p FROM {last} JOIN {name}_l ON leaf = {name}_n)",
              f"{name}_g AS (" + " UNION ALL ".join(f"SELECT * FROM {name}_{i}_b" for i in range(depth)) + ")"]
    return ",\n".join(steps)


DEEP_SQL = f"{FX_SQL}, sp AS (SELECT *, {SPLIT_SQL} AS split FROM fx)"
TREE_SQL = f"WITH {DEEP_SQL},\n{grown_sql('sp', 'y', 't', 3)}"


def _deep_model(spark, sf_dir, name, params):
    df = hash_split(fx(spark, sf_dir), "id", DEEP)
    return df, models.fit_model(df.where("split = 'train'"), DEEP, name, {**BINS, **params}, scaled=False)


def _deep_rows(spark, sf_dir, name, params):
    df, model = _deep_model(spark, sf_dir, name, params)
    return model.transform(df).select("id", F.round("prediction", 9).alias("prediction"))


_TREE_ROWS = f"{TREE_SQL} SELECT id, round(t_p, 9) AS prediction FROM t"


@check(_TREE_ROWS)
def decision_tree_depth_three(spark, sf_dir):
    """A tree of three levels, row by row."""
    return _deep_rows(spark, sf_dir, "DecisionTreeRegressor", {"maxDepth": 3})


@check(_TREE_ROWS)
def random_forest_whole_rows(spark, sf_dir):
    """A forest of four trees that all see all rows and features: each is the tree."""
    return _deep_rows(spark, sf_dir, "RandomForestRegressor",
                      {"maxDepth": 3, "numTrees": 4, "bootstrap": False, "featureSubsetStrategy": "all"})


@check(f"""{TREE_SQL},
r1 AS (SELECT * EXCLUDE (t_p), t_p AS f1, 2 * (y - t_p) AS residual1 FROM t),
{grown_sql('r1', 'residual1', 'u', 3)},
r2 AS (SELECT *, f1 + 0.1 * u_p AS f2, 2 * (y - f1 - 0.1 * u_p) AS residual2 FROM u),
{grown_sql('r2', 'residual2', 'w', 3)}
SELECT id, round(f2 + 0.1 * w_p, 9) AS prediction FROM w""")
def boosted_three_rounds(spark, sf_dir):
    """Three rounds of trees of three levels, each on what the former left, row by row."""
    return _deep_rows(spark, sf_dir, "GradientBoostingRegressor", {"maxDepth": 3, "maxIter": 3, "stepSize": 0.1})


@check(f"""WITH {DEEP_SQL} SELECT id, 7 AS n_trees, true AS is_the_mean, true AS within FROM sp""")
def random_forest_bagged(spark, sf_dir):
    """A forest with bootstrap: each row's prediction is the mean of the forest's own trees.

    The trees are read from the model and scored as expressions; the mean lies within what
    the training rows hold.
    """
    df, model = _deep_model(spark, sf_dir, "RandomForestRegressor",
                            {"maxDepth": 4, "numTrees": 7, "featureSubsetStrategy": "onethird"})
    nodes = models.node_table(spark, model, DEEP.features).collect()
    if len({str(sorted((r.node, r.prediction) for r in nodes if r.tree == t)) for t in range(7)}) != 7:
        raise ValueError("bags must differ")
    low, high = df.where("split = 'train'").agg(F.min("y"), F.max("y")).first()
    return model.transform(df.withColumn("mean", models.tree_score(nodes))).select(
        "id", F.lit(len({r.tree for r in nodes})).alias("n_trees"),
        (F.abs(F.col("prediction") - F.col("mean")) < 1e-12).alias("is_the_mean"),
        F.col("prediction").between(low, high).alias("within"))


_GAINS = """, every AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature, unnest(range(3)) AS pos)
SELECT CAST(pos AS INTEGER) AS pos, feature, round(coalesce(sum(gained), 0) / (SELECT sum(gained) FROM {g}), 9) AS importance
FROM every LEFT JOIN {g} USING (feature) GROUP BY pos, feature"""


def _rounded(importances):
    return importances.select("pos", "feature", F.round("importance", 9).alias("importance"))


@check(TREE_SQL + _GAINS.format(g="t_g"))
def importances_of_a_deep_tree(spark, sf_dir):
    _, model = _deep_model(spark, sf_dir, "DecisionTreeRegressor", {"maxDepth": 3})
    return _rounded(models.importance_table(spark, model, DEEP.features))


@check(TREE_SQL + _GAINS.format(g="t_g"))
def importances_from_nodes(spark, sf_dir):
    """From the node table of a forest whose trees are all the tree."""
    _, model = _deep_model(spark, sf_dir, "RandomForestRegressor", {
        "maxDepth": 3, "numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"})
    return _rounded(models.gain_importances(models.node_table(spark, model, DEEP.features), DEEP.features))


@check(f"""{TREE_SQL}, child AS (SELECT node, feature, v FROM t_g)
SELECT CAST(node AS BIGINT) AS node, feature, count(*) AS rows, round(avg(y), 9) AS prediction,
       round(var_pop(y), 9) AS impurity
FROM (SELECT y, unnest([t_n // 8, t_n // 4, t_n // 2, t_n]) AS node FROM t WHERE split = 'train')
LEFT JOIN child USING (node) WHERE node > 0 GROUP BY ALL""")
def tree_nodes(spark, sf_dir):
    """Every node of a tree: its split, rows, mean and variance."""
    _, model = _deep_model(spark, sf_dir, "DecisionTreeRegressor", {"maxDepth": 3})
    nodes = models.node_table(spark, model, DEEP.features)
    return nodes.select("node", "feature", F.col("rows").cast("bigint").alias("rows"),
                        F.round("prediction", 9).alias("prediction"), F.round("impurity", 9).alias("impurity"))


# ---- the scaler inside the folds ----------------------------------------------------------------

# Without Spark's own standardisation the penalty rests on the scaled values, so the scaler shows.
UNSCALED = replace(FX1, grids={"LinearRegression": {
    "regParam": (0.01, 0.1), "elasticNetParam": (0.0, 0.5, 1.0), "standardization": (False,)}})
OTHERS_SQL = """o AS (SELECT k.fold, corr(y, x) AS r, stddev_pop(x) / stddev_samp(x) AS sx, stddev_pop(y) AS sy,
    avg(x) AS mx, avg(y) AS my, stddev_samp(x) AS unit
  FROM tr, (SELECT DISTINCT fold FROM tr) k WHERE tr.fold <> k.fold GROUP BY k.fold)"""


@check(f"""WITH {TRAIN_SQL}, {OTHERS_SQL} SELECT fold, round(mx, 6) AS mean, round(unit, 6) AS deviation FROM o""")
def fold_scalers(spark, sf_dir):
    """Each fold's scaler knows the other folds only."""
    found = scaling.fold_scalers(train_rows(spark, sf_dir), FX1.features)
    rows = [(k, s.means[0], s.stds[0]) for k, s in found.items()]
    return spark.createDataFrame(rows, "fold int, mean double, deviation double").select(
        "fold", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@check(f"""WITH {TRAIN_SQL}, {OTHERS_SQL},
fit AS (SELECT o.*, grid_id, sign(r) * greatest(abs(r) * sx * sy - alpha * reg, 0)
    / (sx * sx + (1 - alpha) * reg / sy) AS w FROM o, grid),
errors AS (SELECT fold, grid_id, sqrt(avg((y - (my + w * (x - mx) / unit)) ** 2)) AS rmse
    FROM tr JOIN fit USING (fold) GROUP BY ALL)
SELECT grid_id, round(avg(rmse), 7) AS avg_rmse FROM errors GROUP BY grid_id""")
def search_scaled_by_other_folds(spark, sf_dir):
    train = train_rows(spark, sf_dir).persist()
    found = models.grid_search(train, "LinearRegression", UNSCALED,
                               scalers=scaling.fold_scalers(train, UNSCALED.features))
    train.unpersist()
    return spark.createDataFrame(list(enumerate(found.avg_rmse)), "grid_id int, avg_rmse double").select(
        "grid_id", F.round("avg_rmse", 7).alias("avg_rmse"))
