"""The physical plans are the ones meant: pruned scans, few shuffles, no Python in hot paths."""

import re

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks.tables import FX, fx, rn, table
from riskspark.operators import evaluate, explain, prepare, profile, reshape, scenario, serving, split
from riskspark.session import work_path
from riskspark.sources import runs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|RoundRobin|Single)", plan(df)))


@pytest.fixture(scope="module")
def items(spark, sf):
    return table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 110000)


def test_projection_reaches_the_scan(items):
    text = plan(profile.moments(prepare.select_features(items, FX), ["l_tax"]))
    assert "ReadSchema: struct<l_tax:double>" in text


def test_filter_reaches_the_scan(spark, sf):
    events = table(spark, sf, "events")
    text = plan(events.where(F.col("event_id") > 10).select("event_id"))
    assert "GreaterThan(event_id,10)" in text


def test_one_pass_profiles_need_one_small_shuffle(items):
    assert shuffles(profile.null_counts(items)) == 1
    assert "partial_" in plan(profile.null_counts(items))
    assert shuffles(evaluate.evaluate_models(
        items.withColumn("split", F.lit("train")), "y", {"a": "l_tax", "b": "l_discount"})) == 1


@pytest.mark.parametrize("build", [
    lambda d: split.hash_split(d, "l_orderkey", FX),
    lambda d: split.assign_folds(d, "l_orderkey", FX),
    lambda d: scenario.expand_scenarios(d, ["l_orderkey"], FX),
    lambda d: reshape.to_long(d, ["l_orderkey"], FX.features),
    lambda d: explain.row_summary(d, FX.features),
    lambda d: explain.top_factors(d, ["l_orderkey"], FX),
    lambda d: prepare.validate(d, FX.features, 0, 1),
])
def test_row_wise_operators_do_not_shuffle(items, build):
    text = plan(build(items))
    assert shuffles(build(items)) == 0
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_small_dimension_is_broadcast(items):
    long = reshape.to_long(items, ["l_orderkey"], FX.features)
    assert "BroadcastHashJoin" in plan(explain.with_metadata(long, FX))


def test_top_factors_neither_join_nor_shuffle(items):
    shape = plan(explain.top_factors(items, ["l_orderkey"], FX))
    assert "Join" not in shape and "Exchange" not in shape


def test_latest_run_is_a_top_k(spark, sf):
    assert "TakeOrderedAndProject" in plan(runs.latest_run(rn(spark, sf)))


def test_run_log_prunes_experiments(spark, sf):
    path = work_path(spark, "runs")
    runs.append_runs(rn(spark, sf), path)
    text = plan(runs.successful_runs(runs.read_runs(spark, path), "preparation"))
    assert re.search(r"PartitionFilters: \[[^\]]*experiment", text)


def test_cache_lookup_is_a_semi_and_an_anti_join(spark, sf):
    events = table(spark, sf, "events")
    hits, misses = serving.cache_lookup(events, events.select("event_type"), "event_type")
    assert "LeftSemi" in plan(hits) and "LeftAnti" in plan(misses)


def test_only_result_reuse_uses_python(spark, sf):
    """Batch queries stay in the JVM, whatever they do."""
    for name in ("rate_limit", "cooldown", "number_history", "lineage", "new_best_events",
                 "batch_score_requests", "evaluate_models", "standardise"):
        text = plan(QUERIES[name](spark, sf))
        assert "Python" not in text and "InPandas" not in text, name


def test_feature_table_reads_what_is_asked(spark, sf):
    """No exchange and no further columns for a projection of the feature table."""
    text = plan(fx(spark, sf).select("id", "l_tax"))
    assert "Exchange" not in text
    assert "l_quantity" not in text and "l_shipdate" not in text
