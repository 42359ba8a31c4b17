"""Winners per key, idempotent writes, differences and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import written


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order, whole."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__number", number).filter("__number = 1").drop("__number")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], mode: str = "overwrite") -> DataFrame:
    """existing with incoming written over it.  overwrite: incoming's row replaces the columns that it carries; ignore: rows that exist stay."""
    keys = list(keys)
    if mode == "ignore":
        return existing.unionByName(incoming.join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    if mode != "overwrite":
        raise ValueError(mode)
    values = [c for c in incoming.columns if c not in keys]
    fresh = incoming.select(*keys, F.struct(*values).alias("__new"))
    old = existing.withColumn("__old", F.lit(True))
    joined = old.join(fresh, keys, "full_outer")
    columns = keys + [c for c in existing.columns if c not in keys] + [c for c in values if c not in existing.columns]

    def value(c: str) -> Column:
        if c not in values:
            return F.col(c)
        new = F.col(f"__new.{c}")
        return F.when(F.col("__new").isNotNull(), new).otherwise(F.col(c) if c in existing.columns else F.lit(None)).alias(c)

    return joined.select(*[F.col(c) if c in keys else value(c) for c in columns])


def stratified_round_robin(df: DataFrame, stratum: str, order: Sequence[Column | str], n: int) -> DataFrame:
    """One row of each stratum in turn, larger strata first (then those that come first), until n.  order must be total."""
    own = Window.partitionBy(stratum)
    ranked = df.withColumn("__in", F.row_number().over(own.orderBy(*order))).withColumn("__size", F.count("*").over(own))
    # strata come by size, then by their first row
    lead = ranked.filter("__in = 1").withColumn("__stratum", F.row_number().over(Window.orderBy(F.desc("__size"), *order))).select(F.col(stratum).alias("__s"), "__stratum")
    joined = ranked.join(lead, F.col(stratum).eqNullSafe(F.col("__s")))
    return joined.orderBy("__in", "__stratum").limit(n).drop("__in", "__size", "__s", "__stratum")


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """df with the place of each row in the sorted table, from 0.

    The sort deals the rows over tasks; a row's place is the number of rows in earlier tasks plus its place in its own,
    so no task sees all rows.  The sorted table is written, which fixes both.
    """
    sorted_ = written(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()), "sorted")
    part, row = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    counts = sorted_.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))
    before = counts.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__before"))  # one row for each task
    return sorted_.withColumn("__part", part).join(before, "__part").withColumn(name, F.col("__before") + row).drop("__id", "__part", "__before")


def even_spread_sample(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """k rows at even distances of the sorted table."""
    placed = numbered(df, order, "__place")
    total = placed.agg(F.count("*").alias("n"))
    places = total.select(F.explode(F.sequence(F.lit(0), F.lit(max(k - 1, 0)))).alias("j"), "n")
    places = places.select(F.when(F.lit(k) > 1, F.bround(F.col("j") * (F.col("n") - 1) / F.lit(max(k - 1, 1)))).otherwise(0).cast("long").alias("__place")).distinct()
    return placed.join(F.broadcast(places), "__place").drop("__place")  # k rows


def identical_share(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """How many keys of both have the same values in these columns."""
    x, y = a.select(key, F.struct(*columns).alias("x")), b.select(key, F.struct(*columns).alias("y"))
    joined = x.join(y, key, "full_outer")
    same = F.coalesce(F.col("x").eqNullSafe(F.col("y")), F.lit(False))
    return joined.agg(F.count("*").alias("n"), F.count_if(same).alias("identical"))
