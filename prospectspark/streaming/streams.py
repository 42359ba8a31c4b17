"""Repeated scans as streams: running sightings, and each advertisement once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed_table import KeyedTable

SCAN_WINDOW = "28 days"


def sightings(stream: DataFrame, key: str = "refnr", time: str = "ts") -> DataFrame:
    """First and last sighting and their number; the same on a batch and on a stream (update mode)."""
    return stream.groupBy(key).agg(F.min(time).alias("first_seen"), F.max(time).alias("last_seen"), F.count("*").alias("n"))


def united(stored: DataFrame, batch: DataFrame, key: str = "refnr") -> DataFrame:
    """Sightings of both, one row for each key."""
    both = stored.unionByName(batch)
    return both.groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n").alias("n"))


def stream_sightings(stream: DataFrame, path: str, checkpoint: str, key: str = "refnr", time: str = "ts", buckets: int = 64) -> StreamingQuery:
    """Keep the keyed table of sightings at ``path`` up to date.

    Each batch is summed up by itself and merged into the partitions of its keys.  The stream holds no state, however long it runs: what it knows is
    the table.  Rows may come late and in any order; a batch that comes again changes nothing.
    """
    table = KeyedTable(stream.sparkSession, path, (key,), buckets)

    def write(batch: DataFrame, number: int) -> None:
        table.merge(sightings(batch, key, time), number, lambda stored, new: united(stored, new, key))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(stream: DataFrame, key: str = "refnr", time: str = "ts", window: str = SCAN_WINDOW) -> DataFrame:
    """Each advertisement once although scan windows overlap.  State older than the window is dropped."""
    if stream.isStreaming:
        return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, window).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])
