"""Edge values of the column expressions."""

import math

import pytest
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.operators import explain, prepare
from riskspark.spec import REGIONAL, SAMPLE_VALUES

NAN = float("nan")


def column(spark, expression, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_band_limits(spark):
    values = [0.0, 0.2999999, 0.3, 0.5, 0.7, 1.0, 1.2, NAN, None]
    got = column(spark, C.risk_band("p"), [(v,) for v in values], "p double")
    assert got == ["LOW", "LOW", "MODERATE", "HIGH", "CRITICAL", "CRITICAL", "CRITICAL",
                   "CRITICAL", None]


def test_percent_is_capped(spark):
    assert column(spark, C.percent("p"), [(0.25,), (1.2,)], "p double") == [25.0, 100.0]


@pytest.mark.parametrize("train, test, status, gap", [
    (0.95, 0.80, "overfit", True), (0.75, 0.70, "good", False), (0.6, 0.6, "underfit", False),
    (0.8, 0.7, "overfit", True), (0.75, 0.65, "underfit", False)])
def test_fit_status(spark, train, test, status, gap):
    row = spark.createDataFrame([(train, test)], "a double, b double").select(
        C.fit_status("a", "b").alias("s"), C.overfit_gap("a", "b").alias("g")).first()
    assert row["s"] == status
    assert (row["g"] is not None) == gap


def test_sigmoid_saturates(spark):
    got = column(spark, C.link("x", "sigmoid"), [(-1e6,), (0.0,), (1e6,)], "x double")
    assert got == [0.0, 0.5, 1.0]
    with pytest.raises(ValueError):
        C.link("x", "probit")


def test_linear_score_needs_matching_lengths():
    with pytest.raises(ValueError):
        C.linear_score(["a", "b"], [1.0], 0.0)


def sample(spark):
    schema = ", ".join(f"{f} int" for f in REGIONAL.features)
    return spark.createDataFrame([SAMPLE_VALUES], schema)


def test_sample_row_summary(spark):
    row = explain.row_summary(sample(spark), REGIONAL.features).first()
    assert math.isclose(row["avg_value"], 71 / 17)
    assert (row["max_value"], row["max_feature"]) == (9.0, "Siltation")
    assert (row["min_value"], row["min_feature"]) == (1.0, "MonsoonIntensity")


def test_sample_row_top_factors(spark):
    rows = explain.top_factors(sample(spark).withColumn("id", F.lit(1)), ["id"], REGIONAL).orderBy("rank")
    assert [(r["feature"], r["value"]) for r in rows.collect()] == [
        ("Siltation", 9.0), ("IneffectiveDisasterPreparedness", 9.0), ("DamsQuality", 8.0),
        ("DrainageSystems", 8.0), ("CoastalVulnerability", 6.0)]


def test_summary_of_row_with_nulls(spark):
    df = spark.createDataFrame([(None, 2.0), (None, None)], "a double, b double")
    rows = explain.row_summary(df, ["a", "b"]).collect()
    assert (rows[0]["max_feature"], rows[0]["min_feature"]) == ("b", "b")
    assert rows[1]["max_feature"] is None


def test_remaining_seconds(spark):
    rows = [(10_000_000, None), (10_000_000, 10_000_000), (69_500_000, 10_000_000), (71_000_000, 10_000_000)]
    got = column(spark, C.remaining_seconds("now", "since"), rows, "now bigint, since bigint")
    assert got == [0, 60, 0, 0]
    assert column(spark, C.remaining_seconds("now", "since"), [(40_500_000, 10_000_000)],
                  "now bigint, since bigint") == [29]


def test_map_merge_and_default(spark):
    df = spark.sql("select map('a', 1, 'b', 2) as base, map('b', 3, 'c', 4) as over")
    row = df.select(C.merge_maps("base", "over").alias("m"),
                    C.map_default("base", "z", 5).alias("d")).first()
    assert row["m"] == {"a": 1, "b": 3, "c": 4}
    assert row["d"] == 5


def test_validate(spark):
    rows = [("1", "2"), (None, "2"), ("x", "2"), ("0", "11"), ("NaN", "10"), ("1", "10")]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("extra", F.lit(1))
    checked = prepare.validate(df, ["a", "b"], 1, 10)
    assert [r["reason"] for r in checked.collect()] == [
        "", "missing: a", "not a number: a", "out of range: a; out of range: b",
        "not a number: a", ""]
    unbounded = prepare.validate(df, ["a", "b"])
    assert [r["ok"] for r in unbounded.collect()] == [True, False, False, True, False, True]
    assert [r["ok"] for r in prepare.validate(df, ["a"], low=1).collect()] == [
        True, False, False, False, False, True]
    assert [r["ok"] for r in prepare.validate(df, ["b"], high=5).collect()] == [
        True, True, True, False, False, False]
    names = [f"feature_{i}_with_a_long_name" for i in range(17)]
    every = prepare.rejected(prepare.validate(df, names)).first()["reason"]
    assert every == "; ".join(f"missing: {n}" for n in names)
    assert prepare.accepted(prepare.validate(df, names), names).count() == 0
    absent = prepare.validate(df, ["a", "missing"])
    assert all("missing: missing" in r["reason"] for r in absent.collect())


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="missing columns: WetlandLoss"):
        prepare.select_features(sample(spark).drop("WetlandLoss").withColumn(
            REGIONAL.target, F.lit(0.5)), REGIONAL)


@pytest.mark.parametrize("mode, kept", [("skip", 1), ("keep", 3)])
def test_assemble_invalid(spark, mode, kept):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,)], "a double")
    assert prepare.assemble(df, ["a"], handle_invalid=mode).count() == kept
    with pytest.raises(Exception, match="VectorAssembler"):
        prepare.assemble(df, ["a"]).collect()


def test_number_of_values_must_fit_the_names(spark):
    from riskspark.sources.requests import requests_to_df

    for values in ([1.0], [1.0, 2.0, 3.0]):
        df = spark.createDataFrame([(1, values)], "id int, v array<double>")
        with pytest.raises(Exception, match="values where 2 are named"):
            requests_to_df(df, "v", ["a", "b"]).collect()
        with pytest.raises(Exception, match="values where 2 are named"):
            prepare.expand_vector(prepare.vector_from_array(df, "v", "x"), "x", ["a", "b"]).collect()
    df = spark.createDataFrame([(1, None), (2, [3.0, 4.0])], "id int, v array<double>")
    assert [tuple(r) for r in requests_to_df(df, "v", ["a", "b"]).collect()] == [(1, None, None), (2, 3.0, 4.0)]
