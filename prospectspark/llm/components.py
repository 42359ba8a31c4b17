"""Connected components of an edge table, by alternating large-star and small-star (union-find over shuffles).

Nothing is collected: each round joins the edges with the smallest neighbour of each node and is written to the shared folder.
A hub with very many neighbours is split by Spark's skew join, since the smallest neighbour comes from a combined aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """edges: u > v."""
    least = edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("x"))
    moved = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct()


def state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """u, root: for each node with an edge but the smallest of its component, that smallest node.  edges: u, v in any order."""
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    now, before = stored(now, "edges"), None
    while True:
        seen = state(now)
        if seen == before or not seen[0]:
            return now.select("u", F.col("v").alias("root"))
        before = seen
        now = stored(small_star(large_star(now)), "edges")
