"""Stored tables that are changed in parts: only the partitions that a batch touches are written anew.

A keyed table is a Parquet table partitioned by a hash of its key.  A batch reads and writes the partitions of its own keys; the files of all others
stay as they are.  Each batch has a number.  Its merged rows go to a folder of that number first and from there into the table, so a batch that is
repeated, after a crash or because a stream starts again, moves the same rows once more and changes nothing.

Edge cases: a batch without rows changes nothing; a row whose key is null goes to one partition and is merged with no other, as joins do; a batch with a
number below the last one is refused; columns named like the partition column are refused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The partition column of a keyed table.
BUCKET = "bucket"

Rule = Callable[[DataFrame, DataFrame], DataFrame]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, wherever it is stored."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer has finished the folder."""
    return exists(spark, f"{path}/_SUCCESS")


def removed(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write df over the partitions of ``column`` whose values it holds; all others stay."""
    parts = df.repartition(F.col(column))
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


@dataclass(frozen=True)
class KeyedTable:
    """path: its folder; keys: the columns of the key; buckets: number of partitions, which never changes for a stored table."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def dealt(self, df: DataFrame) -> DataFrame:
        if BUCKET in df.columns:
            raise ValueError(f"a column is named {BUCKET}")
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def create(self, df: DataFrame) -> None:
        self.dealt(df).repartition(self.buckets, BUCKET).write.partitionBy(BUCKET).parquet(self.path)

    def rows(self, schema: str | None = None) -> DataFrame:
        """The table; empty with that schema if nothing has been written."""
        if schema is not None and not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def merge(self, incoming: DataFrame, batch: int, rule: Rule) -> None:
        """Bring a batch in.  rule: from the stored rows and the incoming ones of the same partitions to the rows that replace the stored ones."""
        staged, before = f"{self.path}__batch/{batch}", f"{self.path}__batch/{batch - 1}"
        if not complete(self.spark, staged):
            if complete(self.spark, f"{self.path}__batch/{batch + 1}"):
                raise ValueError(f"batch {batch} comes after {batch + 1}")
            dealt = self.dealt(incoming)
            # at most one number for each partition of the table
            touched = [r[0] for r in dealt.select(BUCKET).distinct().collect()]
            if not touched:
                return
            if exists(self.spark, self.path):
                stored = self.spark.read.parquet(self.path).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
                out = rule(stored, incoming)
            else:
                out = rule(incoming.limit(0), incoming)
            self.dealt(out).repartition(BUCKET).write.mode("overwrite").parquet(staged)
        replace_partitions(self.spark.read.parquet(staged), self.path, BUCKET)
        removed(self.spark, before)
