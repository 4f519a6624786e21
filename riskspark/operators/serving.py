"""Serving rules as data operators: history, rate limit, cool-down, result reuse.

Rows carry a client or key, an event time and a unique id that orders equal times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions import columns as C
from riskspark.operators.ordered import (HOT, SLICE, Slices, cut_slices, join_carry, running_fold,
                                         running_number)
from riskspark.session import shared_dir
from riskspark.spec import (COOLDOWN_SECONDS, REQUESTS_PER_WINDOW, REUSE_SECONDS, WINDOW_SECONDS)


# ---- history ------------------------------------------------------------------------------

def number_history(df: DataFrame, client: str, ts: str, id: str, out: str = "number") -> DataFrame:
    """Running number of each row in its client's history, from 1."""
    return running_number(df, [client], [ts, id], out)


def recent_history(df: DataFrame, client: str, ts: str, id: str, n: int = 5) -> DataFrame:
    """The newest ``n`` rows per client, with their number in the whole history.

    Only ``n`` rows per client and task are shuffled (Spark limits the groups before the
    exchange); the history length is a plain count.
    """
    newest = Window.partitionBy(client).orderBy(F.col(ts).desc(), F.col(id).desc())
    latest = df.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= n)
    sizes = df.groupBy(F.col(client).alias("_client")).agg(F.count(F.lit(1)).alias("_rows"))
    return (latest.join(sizes, F.col(client).eqNullSafe(F.col("_client")))
            .withColumn("number", F.col("_rows") - F.col("recency") + 1)
            .drop("_client", "_rows"))


def latest_result(df: DataFrame, client: str, ts: str, id: str) -> DataFrame:
    """The newest row per client; rows are reduced before the shuffle."""
    others = [c for c in df.columns if c != client]
    newest = F.max_by(F.struct(*others), F.struct(ts, id)).alias("_row")
    return df.groupBy(client).agg(newest).select(client, "_row.*")


def retain_since(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """Keep rows from a cutoff time on; a plain filter that reaches the scan."""
    return df.where(F.col(ts) >= F.lit(cutoff))


# ---- rate limit -----------------------------------------------------------------------------

def window_start(ts: str, seconds: int):
    """Start of the clock-aligned window of an event time, in microseconds."""
    us = C.micros(ts)
    return us - F.pmod(us, F.lit(seconds * 1_000_000))


def rate_limit(df: DataFrame, client: str, ts: str, id: str, limit: int = REQUESTS_PER_WINDOW,
               seconds: int = WINDOW_SECONDS, earlier: DataFrame | None = None) -> DataFrame:
    """Number the requests of a client in its window and admit the first ``limit``.

    Adds ``window_us``, ``position``, ``allowed`` and ``retry_after`` (whole seconds until
    the next window for a rejected request, else 0). ``earlier`` holds requests already
    counted, as ``(client, window_us, rows)``.
    """
    windowed = df.withColumn("window_us", window_start(ts, seconds))
    numbered = running_number(windowed, [client, "window_us"], [ts, id], "position",
                              earlier=earlier)
    left = F.ceil((F.col("window_us") + seconds * 1_000_000 - C.micros(ts)) / F.lit(1e6))
    return (numbered.withColumn("allowed", F.col("position") <= limit)
            .withColumn("retry_after", F.when(F.col("allowed"), 0).otherwise(left).cast("int")))


def window_counts(df: DataFrame, client: str, ts: str, limit: int = REQUESTS_PER_WINDOW,
                  seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Requests per client and window with an ``over_limit`` flag."""
    return (df.groupBy(client, window_start(ts, seconds).alias("window_us"))
            .agg(F.count(F.lit(1)).alias("requests"))
            .withColumn("over_limit", F.col("requests") > limit))


def cooldown(df: DataFrame, client: str, ts: str, id: str, allowed: str = "allowed",
             seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """Add ``wait``: seconds a client still has to wait when a request arrives.

    A rejection starts the wait and an admitted request ends it, so the client's previous
    request decides.
    """
    us = C.micros(ts)
    state = F.struct(F.when(~F.col(allowed), us).alias("rejected_us"))
    folded = running_fold(df, [client], [ts, id], {"_state": ("last", state)}, include_current=False)
    return (folded.withColumn("wait", C.remaining_seconds(us, "_state.rejected_us", seconds))
            .drop("_state"))


# ---- result reuse -----------------------------------------------------------------------------

def flag_cached(requests: DataFrame, cache: DataFrame, key: str, out: str = "cached") -> DataFrame:
    """Add whether a request's key has a cached result, by one join over one scan.

    A null key is a key, as in ``reuse_results``. Cached keys are made distinct first, so no
    request is doubled. Spark splits a request key that is hot, and broadcasts the keys only
    if it knows them to be few.
    """
    known = cache.select(F.col(key).alias("_known")).distinct().withColumn("_found", F.lit(True))
    return (requests.join(known, F.col(key).eqNullSafe(F.col("_known")), "left")
            .withColumn(out, F.col("_found").isNotNull()).drop("_known", "_found"))


def cache_lookup(requests: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests with a cached result, and those without; a null key is a key.

    For one of the two. ``flag_cached`` gives both in one frame, over one scan of the requests.
    """
    known = cache.select(F.col(key).alias("_known"))
    same = F.col(key).eqNullSafe(F.col("_known"))
    return requests.join(known, same, "left_semi"), requests.join(known, same, "left_anti")


def reuse_results(df: DataFrame, key: str, ts: str, id: str, seconds: int = REUSE_SECONDS,
                  slices: int | None = None) -> DataFrame:
    """Add ``computed_us`` and ``hit``: which earlier computation serves a request, if any.

    A request is a hit if its key was computed less than ``seconds`` ago; only a miss
    computes, so hits do not prolong a result. The next computation after one at t is the
    first request at or after t + seconds. All columns of ``df`` travel along: select the
    needed ones first. A null key is a key; a request without a time is no hit and computes
    nothing that others could use (``computed_us`` null).

    A hot key spreads over many slices. For each of its slices a task works out where the
    chain of computations leaves the slice for every way of entering it (its leave map).
    Neighbouring slices' maps are composed pairwise, level by level, and the entries handed
    down the same tree, so no task holds more than two maps. With the entries known, all slices
    mark their computations independently.
    """
    ttl = seconds * 1_000_000
    timed = df.withColumn("_us", C.micros(ts))
    ordered = timed.where("_us is not null")
    cut = cut_slices(ordered, [key], ["_us", id], slices)
    sliced = cut.add(ordered)
    if cut.cuts is None:
        entered = sliced.withColumn("_entry_us", F.lit(None).cast("bigint"))
    else:
        entered = sliced.join(F.broadcast(_reuse_entries(sliced, cut, ttl)), [SLICE], "left")
    # A slice's keys go to Python as whole numbers: nulls and long keys stay in the JVM.
    entered = entered.drop(HOT).withColumn(
        "_code", F.dense_rank().over(Window.partitionBy(SLICE).orderBy(key)))
    computed = (entered.select(SLICE, F.col("_code").alias("_key"), "_us", "_entry_us")
                .groupBy(SLICE)
                .applyInPandas(_mark_computations(SLICE, ttl),
                               f"{SLICE} int, _key int, _miss_us bigint"))
    # The computations join their requests as marks in front of them: one more shuffle, no join.
    marks = computed.select(SLICE, F.col("_key").alias("_code"), F.col("_miss_us").alias("_us"),
                            F.lit(0).alias("_row"))
    both = entered.withColumn("_row", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy(SLICE, "_code").orderBy("_us", "_row", id)
    last = F.last(F.when(F.col("_row") == 0, F.col("_us")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The request right behind a mark is the one that computes.
    served = (both.withColumn("hit", F.coalesce(F.lag("_row").over(order) == 1, F.lit(True)))
              .withColumn("computed_us", F.coalesce(last, F.col("_entry_us")))
              .where("_row = 1").drop(SLICE, "_us", "_entry_us", "_row", "_code"))
    untimed = (timed.where("_us is null").drop("_us").withColumn("hit", F.lit(False))
               .withColumn("computed_us", F.lit(None).cast("bigint")))
    return served.unionByName(untimed)


MAPS = f"{HOT} int, place int, first_us bigint, last_us bigint, upto array<bigint>, leaves array<bigint>"


def _reuse_entries(sliced: DataFrame, cut: Slices, ttl: int) -> DataFrame:
    """Last computation before each slice of a hot key: ``(slice, _entry_us)``.

    Levels are checkpointed: each has a map for every second one of the level below, and is
    read on the way up and once more on the way down.
    """
    shared_dir(sliced.sparkSession)
    hot = sliced.where(F.col(HOT).isNotNull())
    first = cut.cuts.select(F.col(HOT).alias("_h"), "_first")
    maps = (hot.join(F.broadcast(first), F.col(HOT) == F.col("_h"))
            .select(HOT, (F.col(SLICE) - F.col("_first")).alias("place"), "_us")
            .groupBy(HOT, "place").applyInPandas(_leave_map(ttl), MAPS).checkpoint())
    levels, size = [maps], cut.longest
    while size > 2:  # the way down needs no map of a whole key
        size = -(-size // 2)
        levels.append(levels[-1].groupBy(HOT, (F.col("place") / 2).cast("int").alias("_pair"))
                      .applyInPandas(_compose_maps(ttl), MAPS).checkpoint())
    entries = levels[-1].select(HOT, F.lit(0).alias("place"),
                                F.lit(None).cast("bigint").alias("_entry_us")).distinct()
    for level in reversed(levels):
        entries = (level.groupBy(HOT, (F.col("place") / 2).cast("int").alias("_pair"))
                   .cogroup(entries.groupBy(HOT, F.col("place").alias("_pair")))
                   .applyInPandas(_hand_down(ttl), f"{HOT} int, place int, _entry_us bigint"))
        entries = entries.checkpoint()
    return (entries.join(F.broadcast(first), F.col(HOT) == F.col("_h")).where("_entry_us is not null")
            .select((F.col("_first") + F.col("place")).cast("int").alias(SLICE), "_entry_us"))


# Shipped to the tasks. A leave map tells, for a computation at e before a slice, the last
# computation when the slice ends. With x = e + ttl: ``leaves[j]`` for x above ``upto[j - 1]`` and
# not above ``upto[j]``; e itself for x above ``last_us``; ``leaves[0]`` if there is none before.

def _left_by(ttl: int, entries, last: int, upto, leaves):
    """The map applied to an array of computations."""
    import numpy as np

    upto, leaves = np.asarray(upto, np.int64), np.asarray(leaves, np.int64)
    at = np.searchsorted(upto, entries + ttl, "left")
    return np.where(entries + ttl > last, entries, leaves[np.minimum(at, len(leaves) - 1)])


def _map_row(hot: int, place: int, first: int, last: int, upto, leaves):
    """One map; neighbouring ranges that are left alike become one."""
    import numpy as np
    import pandas as pd

    ends = np.append(np.flatnonzero(leaves[1:] != leaves[:-1]), len(leaves) - 1)
    return pd.DataFrame({HOT: [hot], "place": [place], "first_us": [first], "last_us": [last],
                         "upto": [upto[ends].tolist()], "leaves": [leaves[ends].tolist()]})


def _leave_map(ttl: int):
    def steps(pdf):
        import numpy as np

        times = np.unique(pdf["_us"].to_numpy())
        n = len(times)
        follow = np.searchsorted(times, times + ttl, "left")
        leave = np.where(follow < n, follow, np.arange(n))
        while (leave[leave] != leave).any():
            leave = leave[leave]
        # An earlier computation expires at most ttl after the slice's first request.
        reach = min(int(np.searchsorted(times, times[0] + ttl, "left")), n - 1)
        return _map_row(int(pdf[HOT].iloc[0]), int(pdf["place"].iloc[0]), int(times[0]),
                        int(times[-1]), times[:reach + 1], times[leave[:reach + 1]])
    return steps


def _compose_maps(ttl: int):
    """One map of two neighbours (or of one that has no second)."""
    def compose(pdf):
        import numpy as np

        pdf = pdf.sort_values("place")
        near = pdf.iloc[0]
        first, last = int(near["first_us"]), int(near["last_us"])
        upto, leaves = np.asarray(near["upto"], np.int64), np.asarray(near["leaves"], np.int64)
        if len(pdf) > 1:
            far = pdf.iloc[1]
            leaves = _left_by(ttl, leaves, int(far["last_us"]), far["upto"], far["leaves"])
            if last < first + ttl:  # a computation before the first slice can outlast it
                beyond = np.asarray(far["upto"], np.int64)
                until = int(np.searchsorted(beyond, first + ttl, "left")) + 1
                new = np.flatnonzero(beyond[:until] > last)
                upto = np.append(upto, beyond[new])
                leaves = np.append(leaves, np.asarray(far["leaves"], np.int64)[new])
            last = int(far["last_us"])
        return _map_row(int(near[HOT]), int(near["place"]) // 2, first, last, upto, leaves)
    return compose


def _hand_down(ttl: int):
    """The entries of a pair's slices from the pair's own entry."""
    def down(maps, entries):
        import numpy as np
        import pandas as pd

        maps = maps.sort_values("place")
        into = entries["_entry_us"].iloc[0] if len(entries) else None
        known = [None if pd.isna(into) else int(into)]
        if len(maps) > 1:
            near = maps.iloc[0]
            known.append(int(near["leaves"][0]) if known[0] is None else int(_left_by(
                ttl, np.array([known[0]]), int(near["last_us"]), near["upto"], near["leaves"])[0]))
        return pd.DataFrame({HOT: maps[HOT].to_numpy(), "place": maps["place"].to_numpy(),
                             "_entry_us": pd.array(known, dtype="Int64")})
    return down


def _mark_computations(slice_name: str, ttl: int):
    def mark(pdf):
        import numpy as np
        import pandas as pd

        codes, keys = pd.factorize(pdf["_key"], use_na_sentinel=False)
        times = pdf["_us"].to_numpy()
        order = np.lexsort((times, codes))
        codes, times = codes[order], times[order]
        entry = pdf["_entry_us"].to_numpy(dtype="float64", na_value=np.nan)[order]
        new = np.ones(len(codes), dtype=bool)
        new[1:] = (codes[1:] != codes[:-1]) | (times[1:] != times[:-1])
        codes, times, entered = codes[new], times[new], ~np.isnan(entry[new])
        n = len(codes)

        # Index of the first request of the same key at or after time + ttl: merge the
        # requests with their expiry times and count the requests in front.
        merged = np.lexsort((np.repeat([0, 1], n), np.concatenate([times + ttl, times]),
                             np.concatenate([codes, codes])))
        is_request = merged >= n
        in_front = np.cumsum(is_request) - is_request
        follow = np.empty(n, dtype=np.int64)
        follow[merged[~is_request]] = in_front[~is_request]

        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        current = []
        for i in first:
            if entered[i]:
                # At most one key per slice brings a computation along.
                end = np.searchsorted(codes, codes[i], "right")
                since = int(pdf["_entry_us"].iloc[order[np.flatnonzero(new)[i]]])
                i = i + int(np.searchsorted(times[i:end], since + ttl, "left"))
                if i == end:
                    continue
            current.append(i)
        current = np.array(current, dtype=np.int64)
        computed = np.zeros(n, dtype=bool)
        while len(current):
            computed[current] = True
            after = follow[current]
            inside = after < n
            after, before = after[inside], current[inside]
            current = after[codes[after] == codes[before]]
        chosen = np.flatnonzero(computed)
        return pd.DataFrame({
            slice_name: np.repeat(pdf[slice_name].iloc[0], len(chosen)),
            "_key": pd.Series(keys).take(codes[chosen]).to_numpy(), "_miss_us": times[chosen]})
    return mark
