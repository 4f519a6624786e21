"""Micro-batches with state in tables.

Spark's keyed state sends all rows of a key to one task. Here every micro-batch runs a
batch operator, which spreads hot keys, and the state is a table that is written anew, as
one version per batch. A batch that is run again reads the version before it and replaces
its own output, so nothing is counted twice.

Layout under a root folder:  output/batch=N   late/batch=N   state/N/{rows,open,clock}

Rows without a time cannot be ordered; they are set aside in late/ with the late ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.functions import columns as C
from riskspark.streaming.events import _folder, written_versions

# (batch, state or None) -> output;  (written output, state or None) -> new state
Step = Callable[[DataFrame, DataFrame | None], DataFrame]


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete state versions: those whose clock, written last, has been committed."""
    return written_versions(spark, path, "clock")


def _write_state(rows: DataFrame, held: DataFrame | None, clock: int, target: str) -> None:
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{target}/rows")
    if held is not None:
        held.write.mode("overwrite").parquet(f"{target}/open")
    (spark.range(1).select(F.lit(clock).alias("clock_us"))
     .write.mode("overwrite").parquet(f"{target}/clock"))


def run_stateful(df: DataFrame, ts: str, step: Step, remember: Step, expiry: str, root: str,
                 delay_seconds: int = 600, in_order: bool = False) -> StreamingQuery:
    """Process what is there and stop; a restart goes on from the last state.

    ``step`` maps a batch and the state to the output, ``remember`` maps the output as
    written and the state to the new state. Rows more than ``delay_seconds``
    behind the newest earlier batch are late: they are set aside whole, not processed.
    State rows whose ``expiry`` column (microseconds) lies behind that limit are dropped,
    since no row that is still in time can need them.

    With ``in_order`` a row waits in the state until the newest time less the delay has passed
    it, so ``step`` sees time in closed stretches, whatever the order of arrival. What still
    waits when the stream has ended is processed by ``release``.
    """
    delay = delay_seconds * 1_000_000

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in _versions(spark, f"{root}/state") if v < number]
        state = clock = None
        if before:
            state = spark.read.parquet(f"{root}/state/{before[-1]}/rows")
            clock = spark.read.parquet(f"{root}/state/{before[-1]}/clock").first()["clock_us"]
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            time = C.micros(ts)
            aside = time.isNull() if clock is None else time.isNull() | (time < clock - delay)
            batch.where(aside).write.mode("overwrite").parquet(f"{root}/late/batch={number}")
            newest = batch.agg(F.max(time)).first()[0]
            if newest is None:
                return
            timely = batch.where(~aside)
            waiting = None
            if in_order:
                if before:
                    timely = timely.unionByName(
                        spark.read.parquet(f"{root}/state/{before[-1]}/open"))
                closed = max(newest, clock or newest) - delay
                waiting, timely = timely.where(time >= closed), timely.where(time < closed)
            written = f"{root}/output/batch={number}"
            step(timely, state).write.mode("overwrite").parquet(written)
            rows = remember(spark.read.parquet(written), state)
            clock = newest if clock is None else max(newest, clock)
            # State is needed from where processed time ends: later rows can still refer to it.
            _write_state(rows.where(F.col(expiry) > clock - delay), waiting, clock,
                         f"{root}/state/{number}")
        finally:
            batch.unpersist()
        for old in before[:-1]:
            path, fs = _folder(spark, f"{root}/state/{old}")
            fs.delete(path, True)

    return (df.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{root}/checkpoint").foreachBatch(process).start())


def release(spark: SparkSession, root: str, step: Step) -> None:
    """Process the rows that still wait after the last batch of an ``in_order`` stream.

    The output goes to a batch of its own; the state stays, so a stream that goes on later
    processes them again in its next batch and replaces nothing: release only at the end.
    """
    last = _versions(spark, f"{root}/state")
    if last:
        state = spark.read.parquet(f"{root}/state/{last[-1]}/rows")
        held = spark.read.parquet(f"{root}/state/{last[-1]}/open")
        step(held, state).write.mode("overwrite").parquet(f"{root}/output/batch={last[-1] + 1}")


def read_output(spark: SparkSession, root: str, part: str = "output") -> DataFrame:
    """What all batches wrote (``output`` or ``late``)."""
    return spark.read.parquet(f"{root}/{part}").drop("batch")
