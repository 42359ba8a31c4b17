"""Mixing sources to target weights by systematic sampling.  DataFrame operations only.

Each document of a source is expected ``target / source_size`` times (at most ``max_repeats``).  The documents of a source
stand in one fixed order; the running sum of expected copies, shifted by one random offset, crosses whole numbers, and the
document in which a boundary is crossed is emitted once for each.  So a source's number of copies is exact to one, a
document comes floor or ceil of its expectation times, and since the order goes by size, large and small
documents are taken evenly and the taken words come near the target.

Targets: sources in order of code points, null last, weigh ``weights`` in turn and share the total of all sizes; a
target stops at ``max_repeats`` times its source's size and the excess is shared by weight among the others, until none is
above.  That is the level L with sum(min(max_repeats * size, L * weight)) = total, found on the sorted sources directly.

Scale: the running sum isn't taken over a source at once, since one source may hold a third of all rows.  A source is cut into
blocks by size class and a hash of doc_id, of about the square root of the class' rows each in a large table.  The running sum is taken in
three steps: over the size classes of a source (a few hundred at most), over the blocks of a class, and over the rows of a block.  Even and
odd blocks run in opposite directions of size, so that the places where two blocks meet add no bias.

Edge cases: null text has size 0; null source is a source of its own; a source without words has target 0 and
isn't taken; a very long text is one row of a high size class like any other; rows that repeat a doc_id count each and are taken each on its
own, as are rows without doc_id, which are dealt to blocks by their text; doc_id may be any long; in a block equal sizes and ids stand in
the order of their texts' hash, and of their other columns'; an empty table gives an empty result; ``copies`` ignores other columns,
``mix_sources`` carries the whole row to its place, so it joins on no id and names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from .common import WORD, read_table, stored

#: A size class has at least BLOCKS blocks, and more so long as they hold BLOCK_ROWS rows and more on average.
BLOCK_ROWS = 4096
BLOCKS = 64
#: A prime: block numbers and offsets are reckoned modulo it, so that whole numbers of any size stay in range.
PRIME = 1_000_003


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: float) -> DataFrame:
    """source, source_size, target, offset of each source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # sources are few; the documents were summed before
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    every = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        by_source.withColumn("rank", F.row_number().over(order)).withColumn("weight", weight)
        .withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    # with the k sources of the smallest ratios at their caps, the others share what is left at this level; it rises with
    # k as long as it is above the next ratio, and falls from there
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level).withColumn("level", F.max("level").over(every))
    target = F.when(F.col("ratio") <= F.col("level"), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return levels.select("source", "source_size", F.coalesce(F.least(target, F.col("cap")), F.lit(0.0)).alias("target"), "rank")


def copies(documents: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: float = 3, seed: int = 7, key: str = "doc_id", whole: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row: how often the mix takes it.  whole: also row, all its columns."""
    # mixed: a fixed hash in whole numbers, so that SQL can repeat it; without doc_id the text's
    spread = F.pmod(F.coalesce(F.col(key), F.xxhash64("text")), F.lit(PRIME))
    columns = [F.col(key).alias("doc_id"), F.col("source"), size_of(F.col("text")).alias("size"), F.pmod((spread + seed % PRIME) * 7919, F.lit(PRIME)).alias("mixed")]
    sizes = stored(documents.select(*columns), "mix-sizes")
    targets = stored(source_targets(sizes, weights, max_repeats), "mix-targets")
    n = sizes.count()
    parts = max(BLOCKS, n // max(BLOCK_ROWS, int(n**0.5)))
    class_ = F.floor(F.log2(F.col("size") + 1) * 8).cast("int")  # eight to a factor of two

    def rated(table: DataFrame) -> DataFrame:
        joined = table.join(targets, table["source"].eqNullSafe(targets["source"])).drop(targets["source"])
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        return joined.withColumn("class", class_).withColumn("part", F.pmod("mixed", F.lit(parts)).cast("int")).withColumn("rate", rate)

    rows = rated(sizes)
    counts = stored(rows.groupBy("rank", "class", "part").agg(F.count("*").alias("rows")), "mix-blocks")
    classes = counts.groupBy("rank", "class").agg(F.sum("rows").alias("rows"), F.count("*").alias("blocks"))
    by_class, by_part = Window.partitionBy("rank").orderBy("class"), Window.partitionBy("rank", "class").orderBy("part")
    starts = classes.select("rank", "class", (F.sum("rows").over(by_class) - F.col("rows")).alias("rows_before"), (F.sum("blocks").over(by_class) - F.col("blocks")).alias("blocks_before"))
    within_class = counts.select("rank", "class", "part", (F.sum("rows").over(by_part) - F.col("rows")).alias("rows_here"), F.row_number().over(by_part).alias("number"))
    blocks = within_class.join(starts, ["rank", "class"]).select(
        "rank", "class", "part", (F.col("rows_before") + F.col("rows_here")).alias("before"), ((F.col("blocks_before") + F.col("number")) % 2).alias("odd")
    )
    ties, carried = [], []
    if whole:
        plain = [f.name for f in documents.schema if isinstance(f.dataType, AtomicType)]
        rest = F.xxhash64(*[F.col(f"row.`{name}`") for name in plain])
        rows, ties, carried = rated(documents.select(*columns, F.struct("*").alias("row"))), [F.xxhash64("row.text"), rest], ["row"]
    within = Window.partitionBy("rank", "class", "part").orderBy(F.col("size") * F.when(F.col("odd") == 1, 1).otherwise(-1), "doc_id", *ties)
    # the offset of a source: a fraction that follows from its rank and the seed
    offset = F.pmod((F.col("rank").cast("long") * 7919 + seed % PRIME) * 104_729, F.lit(PRIME)) / float(PRIME)
    placed = rows.join(blocks, ["rank", "class", "part"]).withColumn("place", F.col("before") + F.row_number().over(within))
    taken = F.floor(F.col("place") * F.col("rate") + offset) - F.floor((F.col("place") - 1) * F.col("rate") + offset)
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("copies"), *carried)


def mix_sources(documents: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: float = 3, seed: int = 7) -> DataFrame:
    """The mix itself: each row of documents as often as it is taken, whether its doc_id is its own, repeated or null."""
    chosen = copies(documents, weights, max_repeats, seed, whole=True).filter("copies > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = copies(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = r"""
with s as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
b as (select source, sum(size)::bigint as source_size from s group by source),
r as (select *, row_number() over (order by source asc nulls last) as rank from b),
w as (select *, case (rank - 1) % 3 when 0 then 1.0::double when 1 then 2.0::double else 3.0::double end as weight, 3.0::double * source_size as cap from r),
q as (select *, cap / weight as ratio from w),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by ratio, rank rows between unbounded preceding and 1 preceding), 0))
  / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, rank rows between unbounded preceding and 1 preceding), 0)) as lev from q),
m as (select *, max(lev) over () as level from l),
t as (select source, source_size, rank, coalesce(least(case when ratio <= level then cap else level * weight end, cap), 0.0::double) as target from m),
d as (select s.doc_id, s.size, t.source_size, t.target, t.rank, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
  floor(log2(s.size + 1) * 8)::int as class, ((((coalesce(s.doc_id, -1) % 1000003 + 1000003) % 1000003 + 7) * 7919) % 1000003) % greatest(64, count(*) over () // greatest(4096, floor(sqrt(count(*) over ()))::bigint)) as part
  from s join t on s.source is not distinct from t.source),
c as (select rank, class, part, count(*) as n from d group by all),
k as (select rank, class, part, sum(n) over (partition by rank order by class, part) - n as before, row_number() over (partition by rank order by class, part) % 2 as odd from c),
p as (select d.*, before + row_number() over (partition by rank, class, part order by size * case when odd = 1 then 1 else -1 end, doc_id) as place
  from d join k using (rank, class, part))
select doc_id, size, source_size, target,
 (size * (floor(place * rate + (((rank * 7919 + 7) * 104729) % 1000003) / 1000003.0::double) - floor((place - 1) * rate + (((rank * 7919 + 7) * 104729) % 1000003) / 1000003.0::double)))::bigint as taken from p
"""
