"""Substring search by grams: what contains a word has all the word's grams, so rows and words meet by a gram and only those that do are compared.

Two forms: many keys against many texts (``containing``), where each key has one anchor gram, and few words against a stored index (``search``), where the
posting lists of all their grams are intersected.  Either way a hit is verified in the text itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similar import PLACES, RARE_FIRST

c = F.col
#: Longest anchor, and the grams of an index.
ANCHOR, GRAM = 4, 3
#: Partitions of a stored index.
PARTS = 64


def grams(text: Column, width: int) -> Column:
    """The different grams of a text, none if it is shorter."""
    last = F.length(text) - width + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(width))))).otherwise(F.array().cast("array<string>"))


def rarest(text: Column, width: int) -> Column:
    """The gram whose letters are the rarest."""
    rated = F.transform(grams(text, width), lambda g: F.struct(F.translate(F.lower(g), RARE_FIRST, PLACES).alias("order"), g.alias("gram")))
    return F.array_min(rated)["gram"]


def containing(texts: DataFrame, text: str, keys: DataFrame, key: str) -> DataFrame:
    """All columns of both for every text that contains a key, capitals counted.  The empty key is in every text that isn't null."""
    width = F.least(F.length(key), F.lit(ANCHOR))
    anchor = F.coalesce(*[F.when(width == w, rarest(c(key), w)) for w in range(1, ANCHOR + 1)], F.lit(""))
    anchored = keys.filter(c(key).isNotNull()).withColumn("__width", width).withColumn("__anchor", anchor)
    widths = sorted(r[0] for r in anchored.select("__width").distinct().collect())  # ANCHOR + 1 at most
    if not widths:
        return texts.join(keys.limit(0), F.lit(False))
    sized = lambda w: F.transform(grams(c(text), w) if w else F.array(F.lit("")), lambda g: F.struct(F.lit(w).alias("__width"), g.alias("__anchor")))
    own = F.flatten(F.array(*[sized(w) for w in widths]))
    # a small file may hold many grams: its size says nothing of them, so neither side is sent whole to all tasks
    met = texts.filter(c(text).isNotNull()).withColumn("__g", F.explode(own)).select(*texts.columns, "__g.*").join(anchored.hint("merge"), ["__width", "__anchor"])
    return met.filter(F.contains(c(text), c(key))).drop("__width", "__anchor")


def part_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


def write_index(rows: DataFrame, key: str, text: Column, path: str) -> None:
    """Posting lists of the texts' grams (lower-cased): part, gram, key."""
    low = F.lower(F.coalesce(text, F.lit("")))
    postings = rows.select(key, F.explode(grams(low, GRAM)).alias("gram")).withColumn("part", part_of(c("gram")))
    postings.repartition(PARTS, "part").sortWithinPartitions("part", "gram").write.partitionBy("part").parquet(path)


def candidates(index: DataFrame, key: str, words: Sequence[str]) -> DataFrame | None:
    """Keys of the texts that have all grams of all words; None if no word is long enough to have one."""
    wanted = sorted({w.lower()[i : i + GRAM] for w in words for i in range(len(w) - GRAM + 1)})
    if not wanted:
        return None
    spark = index.sparkSession
    asked = spark.createDataFrame([(g,) for g in wanted], "gram string")
    parts = [r[0] for r in asked.select(part_of(c("gram"))).distinct().collect()]
    hits = index.filter(c("part").isin(parts) & c("gram").isin(wanted))  # both reach the scan
    return hits.groupBy(key).agg(F.count("*").alias("n")).filter(c("n") == len(wanted)).select(key)


def search(rows: DataFrame, key: str, text: Column, index: DataFrame, words: Sequence[str]) -> DataFrame:
    """The rows whose text contains every word, capitals aside.  Words too short for a gram are looked for in what the others leave, or in all rows."""
    given = [w for w in words if w]
    found = candidates(index, key, given)
    chosen = rows if found is None else rows.join(found, key, "left_semi")
    low = F.lower(F.coalesce(text, F.lit("")))
    for w in given:
        chosen = chosen.filter(F.contains(low, F.lit(w.lower())))
    return chosen
