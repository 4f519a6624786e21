"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  folder of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local cores            (default 8)
BENCH_QUERIES comma-separated subset (default: all headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import QUERIES  # noqa: E402
from checks.tables import FX, fx, rx, table  # noqa: E402
from riskspark import get_session  # noqa: E402
from riskspark.operators import models, scaling  # noqa: E402
from riskspark.operators.prepare import assemble  # noqa: E402
from riskspark.operators.split import assign_folds, hash_split  # noqa: E402
from riskspark.plans.scoring import score_table  # noqa: E402
from riskspark.spec import REGIONAL  # noqa: E402

CHECKED = [
    "null_counts", "duplicate_rows", "feature_moments", "split_sizes", "write_prepared",
    "standardise", "scaler_model", "validate_accepted", "evaluate_models",
    "score_linear_columns", "batch_score_requests", "band_report", "row_summary", "top_factors",
    "expand_scenarios", "wide_to_long", "linear_grid_search", "held_out_bands",
    "number_history", "recent_history", "rate_limit", "cooldown", "reuse_results",
    "window_counts", "lineage", "new_best_events", "run_details", "champion",
]


def checked(name):
    def run(spark, sf_dir):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return run


def _folded(spark, sf_dir, spec):
    df = assign_folds(hash_split(rx(spark, sf_dir), "id", spec), "id", spec)
    train = df.where("split = 'train'")
    return scaling.apply_scaler(train, scaling.fit_scaler(train, spec.features)).select(
        *spec.kept, "fold")


def _vectors(spark, sf_dir, spec):
    # The table is one row group: its rows are dealt out once, for all fits.
    return (assemble(_folded(spark, sf_dir, spec), spec.features)
            .select("features", spec.target, "fold").repartition(spark.sparkContext.defaultParallelism)
            .persist(StorageLevel.MEMORY_AND_DISK))


def linear_search_17_features(spark, sf_dir):
    """6 grid points x 3 folds over 17 features."""
    train = _vectors(spark, sf_dir, REGIONAL)
    models.grid_search(train, "LinearRegression", REGIONAL)
    train.unpersist()


def full_search(spark, sf_dir):
    """All 27 declared grid points x 3 folds over 17 features; run only if asked for by name."""
    train = _vectors(spark, sf_dir, REGIONAL)
    for name in REGIONAL.grids:
        models.grid_search(train, name, REGIONAL)
    train.unpersist()


def tree_search_one_point(spark, sf_dir):
    """3 cross-validated fits of one decision tree grid point (depth 5) over 17 features."""
    spec = replace(REGIONAL, grids={"DecisionTreeRegressor": {
        "maxDepth": (5,), "minInstancesPerNode": (1,)}})
    train = _vectors(spark, sf_dir, spec)
    models.grid_search(train, "DecisionTreeRegressor", spec)
    train.unpersist()


FITTED = {}


def fit_boosted_trees(spark, sf_dir):
    """Fit 20 boosted trees of depth 3 on four features."""
    FITTED["trees"] = models.fit_model(fx(spark, sf_dir), FX, "GradientBoostingRegressor",
                                       {"maxIter": 20, "maxDepth": 3},
                                       partitions=spark.sparkContext.defaultParallelism)


def score_boosted_trees(spark, sf_dir):
    """Score every row with them."""
    if "trees" not in FITTED:
        fit_boosted_trees(spark, sf_dir)
    score_table(fx(spark, sf_dir), FITTED["trees"], FX).write.format("noop").mode("overwrite").save()


EXTRA = {f.__name__: f for f in (linear_search_17_features, tree_search_one_point,
                                 fit_boosted_trees, score_boosted_trees)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session("bench", f"local[{cpus}]", {
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    todo = {**{n: checked(n) for n in CHECKED}, **EXTRA}
    chosen = os.environ.get("BENCH_QUERIES")
    if chosen:
        todo = {n: {**todo, "full_search": full_search}[n] for n in chosen.split(",")}

    rows = table(spark, sf_dir, "lineitem").agg(F.count("*")).first()[0]
    QUERIES["split_sizes"](spark, sf_dir).collect()  # start the JVM's compilers
    seconds = {}
    for name, run in todo.items():
        started = time.perf_counter()
        run(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:32s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    report = {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
              "cores": cpus, "lineitem_rows": rows}
    if "score_linear_columns" in seconds:
        report["linear_scoring_rows_per_sec"] = round(rows / seconds["score_linear_columns"])
    if "score_boosted_trees" in seconds:
        report["tree_scoring_rows_per_sec"] = round(rows / seconds["score_boosted_trees"])
    if "tree_search_one_point" in seconds:
        report["sec_per_cv_tree_fit"] = round(seconds["tree_search_one_point"] / 3, 3)
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
