"""When advertisements appear and when they are gone, from a stream of sightings.

Each advertisement has one row of state while it is open: its first and last sighting and their number.  A timer at the last sighting plus ``quiet``
closes it, once the watermark has passed: it is reported as gone and its state goes with it.  So the state holds the advertisements of the last
``quiet`` (and the watermark's delay), however long the stream runs.

Edge cases: rows may come late and in any order up to the watermark's delay, and count for the advertisement that is open then; rows that are later than
that, and rows without key or time, are left out; an advertisement that comes back after it was gone appears anew; a stream that stops goes on from its
checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENTS = "{key} string, event string, at timestamp, first_seen timestamp, last_seen timestamp, n long"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, for streams that start inside; afterwards the session is as before."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def at(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, UTC)


class Lifecycle(StatefulProcessor):
    """Times are milliseconds."""

    def __init__(self, key: str, quiet: int):
        self.key, self.quiet = key, quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first long, last long, n long")

    def report(self, key: str, event: str, first: int, last: int, n: int) -> tuple:
        return key, event, at(first if event == "appeared" else last + self.quiet), at(first), at(last), n

    def frame(self, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(out, columns=[self.key, "event", "at", "first_seen", "last_seen", "n"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.open.get() if self.open.exists() else None
        first, last, n = before or (0, 0, 0)
        out: list[tuple] = []
        for t in sorted(t for batch in rows for t in batch["millis"].tolist()):
            if n and t > last + self.quiet:
                out.append(self.report(key[0], "gone", first, last, n))
                n = 0
            if not n:
                first, last = t, t
                out.append(self.report(key[0], "appeared", t, t, 1))
            first, last, n = min(first, t), max(last, t), n + 1
        if n:
            if before:
                self.handle.deleteTimer(before[1] + self.quiet)
            self.open.update((first, last, n))
            self.handle.registerTimer(last + self.quiet)
        yield from self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        if self.open.exists():
            first, last, n = self.open.get()
            if last + self.quiet <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.clear()
                out.append(self.report(key[0], "gone", first, last, n))
        yield from self.frame(out)

    def close(self) -> None:
        pass


def stream_lifecycle(stream: DataFrame, quiet_days: float, delay: str, key: str = "refnr", time: str = "ts") -> DataFrame:
    """A stream of events: appeared (at its first sighting) and gone (at its last sighting plus quiet).  To be started within rocksdb_state."""
    rows = stream.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    rows = rows.select(F.col(key).cast("string").alias(key), time, F.unix_millis(time).alias("millis"))
    return rows.groupBy(key).transformWithStateInPandas(Lifecycle(key, int(quiet_days * 86_400_000)), EVENTS.format(key=key), "Append", "EventTime")


def batch_lifecycle(df: DataFrame, quiet_days: float, key: str = "refnr", time: str = "ts") -> DataFrame:
    """The same events of a stored table, those of advertisements that are still open included: gone has no ``at`` beyond the table's last sighting."""
    quiet = int(quiet_days * 86_400_000)
    rows = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).cast("string").alias(key), F.unix_millis(F.col(time).cast("timestamp")).alias("t"))
    order = Window.partitionBy(key).orderBy("t")
    starts = F.when(F.col("t") > F.lag("t").over(order) + quiet, 1).otherwise(0)
    runs = rows.withColumn("run", starts).withColumn("run", F.sum("run").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    open_ = runs.groupBy(key, "run").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n"))
    end = open_.groupBy().agg(F.max("last").alias("end"))
    stamp = lambda c: F.timestamp_millis(c)
    both = open_.crossJoin(end).select(  # end: one row
        key,
        F.inline(
            F.array(
                F.struct(F.lit("appeared").alias("event"), stamp(F.col("first")).alias("at"), stamp(F.col("first")).alias("first_seen"), stamp(F.col("first")).alias("last_seen"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit("gone").alias("event"), F.when(F.col("last") + quiet <= F.col("end"), stamp(F.col("last") + quiet)).alias("at"), stamp(F.col("first")).alias("first_seen"), stamp(F.col("last")).alias("last_seen"), F.col("n").alias("n")),
            )
        ),
    )
    return both.filter("at is not null")
