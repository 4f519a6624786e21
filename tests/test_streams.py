"""Streams: late rows, restarts, and equality with the batch operators."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from riskspark.operators import serving
from riskspark.streaming import events as E
from riskspark.streaming import serving as S
from riskspark.streaming.keyed import read_merged
from riskspark.streaming.stateful import read_output

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "client string, ts timestamp, id int"


def feed(spark, path, rows):
    """One more file of (client, second, id) rows."""
    data = [(c, START + timedelta(seconds=s), i) for c, s, i in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return E.with_event_time(E.read_stream(spark, path, SCHEMA, max_files=1))


def drain(df, out, checkpoint, mode="append"):
    query = E.write_stream(df, out, checkpoint, mode)
    query.awaitTermination()
    return query


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    src, out, chk = (f"{tmp_path}/{n}" for n in ("src", "out", "chk"))
    feed(spark, src, [("a", 0, 1), ("a", 7200, 2)])
    feed(spark, src, [("a", 7300, 3)])
    feed(spark, src, [("a", 10, 4), ("a", 7000, 5)])  # row 4 is behind the watermark, row 5 is not
    counts = S.closed_window_counts(stream(spark, src), "client", "ts", 10, 60)
    query = drain(counts, out, chk)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
                  for op in p["stateOperators"])
    assert dropped == 1
    assert spark.read.parquet(out).count() == 1  # only the first minute is closed


def test_rate_limit_goes_on_after_a_restart(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    feed(spark, src, [("a", s, s) for s in range(7)] + [("b", 3, 100)])
    S.rate_limit_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    feed(spark, src, [("a", s, s) for s in range(7, 12)] + [("a", 61, 61)])
    feed(spark, src, [("a", 62, 62), ("a", 20, 20)])
    S.rate_limit_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    rows = {(r["client"], r["id"]): r["allowed"] for r in read_output(spark, root).collect()}
    assert len(rows) == 16
    assert {k for k, allowed in rows.items() if not allowed} == {("a", 10), ("a", 11), ("a", 20)}


def test_late_rows_are_set_aside(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    for rows in ([("a", 0, 1), ("a", 7200, 2)], [("a", 10, 3), ("a", 7000, 4)]):
        feed(spark, src, rows)
    S.rate_limit_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    assert [r["id"] for r in read_output(spark, root, "late").collect()] == [3]
    assert sorted(r["id"] for r in read_output(spark, root).collect()) == [1, 2, 4]


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """A batch that failed after writing its output and state is run again."""
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    for i in range(3):
        feed(spark, src, [("a", 20 * i + s, 20 * i + s) for s in range(6)])
    S.rate_limit_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    for name in ("2", ".2.crc"):
        (tmp_path / "job" / "checkpoint" / "commits" / name).unlink()
    S.rate_limit_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    rows = read_output(spark, root).collect()
    assert len(rows) == 18
    assert sorted(r["position"] for r in rows) == list(range(1, 19))


def test_reuse_stream_equals_batch(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    rows = [("x", s, i) for i, s in enumerate((0, 59, 60, 100, 121, 2000, 2010, 2060, 5000))]
    feed(spark, src, rows[:3])
    feed(spark, src, rows[3:6])
    feed(spark, src, rows[6:])
    S.reuse_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    S.reuse_release(spark, "client", "ts", "id", root)
    got = {r["id"]: (r["computed_us"], r["hit"]) for r in read_output(spark, root).collect()}
    batch = serving.reuse_results(spark.read.parquet(src), "client", "ts", "id").collect()
    assert got == {r["id"]: (r["computed_us"], r["hit"]) for r in batch}
    assert [i for i in sorted(got) if not got[i][1]] == [0, 2, 4, 5, 7, 8]


def test_reuse_stream_waits_for_earlier_requests(spark, tmp_path):
    """A request that is in time but out of order takes its place among those before it."""
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    feed(spark, src, [("x", 50, 0), ("x", 70, 1)])
    feed(spark, src, [("x", 10, 2), ("x", 100, 3)])
    feed(spark, src, [("x", 5000, 4), (None, 4990, 5), (None, 4991, 6)])
    S.reuse_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    assert sorted(r["id"] for r in read_output(spark, root).collect()) == [0, 1, 2, 3]
    S.reuse_release(spark, "client", "ts", "id", root)
    got = {r["id"]: (r["computed_us"], r["hit"]) for r in read_output(spark, root).collect()}
    batch = serving.reuse_results(spark.read.parquet(src), "client", "ts", "id").collect()
    assert got == {r["id"]: (r["computed_us"], r["hit"]) for r in batch}
    assert got[3][1] and not got[2][1] and got[6][1]


def test_rows_without_a_time_are_set_aside(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    for i in range(2):
        feed(spark, src, [("a", i, i)])
        (spark.createDataFrame([("a", None, 10 + i)], SCHEMA).coalesce(1)
         .write.mode("append").parquet(src))
    S.rate_limit_stream(stream(spark, src), "client", "ts", "id", root).awaitTermination()
    assert sorted(r["id"] for r in read_output(spark, root).collect()) == [0, 1]
    assert sorted(r["id"] for r in read_output(spark, root, "late").collect()) == [10, 11]


def test_complete_tables_are_replaced_whole(spark, tmp_path):
    src, out, chk = (f"{tmp_path}/{n}" for n in ("src", "out", "chk"))
    for i in range(4):
        feed(spark, src, [("a", i, i), ("b", i, 10 + i)])
    drain(S.latest_result_stream(stream(spark, src), "client", "ts", "id"), out, chk, "complete")
    assert len(E.written_versions(spark, out)) == 2
    assert sorted(r["id"] for r in E.read_complete(spark, out).collect()) == [3, 13]


def latest(spark, src, root, buckets=8):
    S.latest_result_table(stream(spark, src), "client", "ts", "id", root, buckets).awaitTermination()
    rows = read_merged(spark, root, stream(spark, src).schema).collect()
    return {r["client"]: (r["id"], r["changed_in"]) for r in rows}


def test_latest_table_rewrites_only_touched_buckets(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    names = [f"c{i}" for i in range(40)]
    feed(spark, src, [(c, 0, i) for i, c in enumerate(names)] + [(None, 5, 100)])
    feed(spark, src, [("c3", 9, 200), ("c3", 8, 201), ("c4", -9, 202)])  # the last is late
    got = latest(spark, src, root)
    assert got == {**{c: (i, 0) for i, c in enumerate(names)}, None: (100, 0), "c3": (200, 1)}
    touched = list((tmp_path / "job" / "rows" / "1").glob("bucket=*"))
    assert 1 <= len(touched) <= 2
    changed = read_merged(spark, root, stream(spark, src).schema, since=1).collect()
    assert [(r["client"], r["id"]) for r in changed] == [("c3", 200)]


def test_latest_table_goes_on_and_repeats(spark, tmp_path):
    """A restart goes on, a repeated batch changes nothing, unnamed versions are deleted."""
    src, root = f"{tmp_path}/src", f"{tmp_path}/job"
    assert read_merged(spark, root, stream_schema(spark)).count() == 0
    for i in range(4):
        feed(spark, src, [("a", i, i), (f"b{i}", i, 10 + i)])
        got = latest(spark, src, root)
    assert got == {"a": (3, 3), **{f"b{i}": (10 + i, i) for i in range(4)}}
    for name in ("3", ".3.crc"):
        (tmp_path / "job" / "checkpoint" / "commits" / name).unlink()
    assert latest(spark, src, root) == got
    assert E.written_versions(spark, f"{root}/manifest") == [2, 3]
    named = {(r["version"], r["bucket"]) for v in (2, 3)
             for r in spark.read.parquet(f"{root}/manifest/{v}").collect()}
    on_disk = {(int(p.parent.name), int(p.name.split("=")[1]))
               for p in (tmp_path / "job" / "rows").glob("*/bucket=*")}
    assert on_disk == named
    feed(spark, src, [("a", 9, 9)])
    with pytest.raises(StreamingQueryException, match="8 buckets"):
        latest(spark, src, root, buckets=4)


def stream_schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_scored_stream_of_requests_needs_no_state(spark, tmp_path, sf):
    from checks.tables import FX, fx
    from riskspark.operators.models import fit_model

    items = fx(spark, sf)
    model = fit_model(items, FX, "DecisionTreeRegressor", {"maxDepth": 2})
    src, out, chk = (f"{tmp_path}/{n}" for n in ("src", "out", "chk"))
    items.drop("y").repartition(2).write.parquet(src)
    asked = E.read_stream(spark, src, items.drop("y").schema, max_files=1)
    drain(S.score_stream(asked, ["id"], model, FX), out, chk)
    scored = spark.read.parquet(out)
    assert scored.count() == items.count()
    assert scored.agg(F.countDistinct("prediction")).first()[0] <= 4


def test_the_event_feed_is_three_batches_however_many_files(spark, tmp_path):
    """A table of many files: no batch ends inside a third, so no row is late."""
    from checks import stream_checks

    rows = [(i, START.replace(tzinfo=None) + timedelta(hours=i), i % 3, "ab"[i % 2], 1.0, "{}") for i in range(720)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                         "value double, props string")
    for k in range(5):  # some files lie in one third alone
        (events.where(F.col("event_id") % 10 == k if k < 3 else (F.col("event_id") % 10 >= 3)
                      & ((F.col("event_id") < 400) == (k == 3)))
         .coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        out = stream_checks.stream_reuse(spark, str(tmp_path))
        assert out.count() == 720
        late = stream_checks.stream_late_rows(spark, str(tmp_path))
        assert late.count() == 240
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
