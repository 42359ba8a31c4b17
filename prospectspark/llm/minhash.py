"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Sets: the distinct shingles of ``shingle`` words, A-Z lower-cased, as 64-bit hashes.  Documents with one set form a class (found by a
128-bit digest) and only classes go on, so copies by the thousand cost one.

SuperMinHash: every element brings one random permutation of the signature's slots, and at level j it offers j + r_j
(r_j uniform) to the slot at place j of its permutation; a slot keeps the least offer.  So an element's offers are spread over the slots
(ranks are correlated, which lowers the variance), and as a level's offers are above all of earlier levels, a signature is complete
when every slot is taken: levels stop early, after one or two for documents longer than the signature.

Banding: 32 bands of 4 slots; of two documents with similarity 0.8 all bands differ with probability 5e-8.
Links are confirmed on full sets.  First each bucket's members are held against its smallest one; confirmed links give
components.  Then the buckets that still hold more than one component are searched again: first each member against the few most
alike of other components, which joins most of what belongs together, then every pair of members of different
components whose sizes and signatures allow the similarity.  So no pair that shares a band goes unseen unless it is
linked already or its signatures are far apart (SLACK), and a group of thousands of copies needs about as many comparisons on full sets as it
has members.  A large bucket is dealt over pairs of blocks: no task gets the whole bucket and no list of all pairs is made.

Edge cases: null and empty texts have no shingles and link with nothing; a text with fewer words than a shingle is one shingle; rows
without doc_id have component_id null, link with nothing and are kept; rows that repeat a doc_id are nodes by their text, and an id's
component is that of the row's own text; a very long text makes a step of its own and its whole set counts; of equal sets the smallest doc_id
stands for all; an empty table gives an empty result; other columns are kept by ``drop_near_duplicates``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, mix, read_table, shuffle_partitions, stored, text_bytes, text_steps, words_of
from .components import components

#: All slots estimate a similarity; the first BANDS * ROWS of them are banded.
SLOTS, BANDS, ROWS = 512, 32, 4
BASE = 0x9E3779B97F4A7C15
BLOCK = 2048
#: A pair is confirmed on full sets unless its signatures agree in less than the threshold minus this: four standard deviations, which loses about
#: 3e-5 of the pairs exactly at the threshold.  A wider bound (0.10) failed in the check tool: too many pairs in a large group of near copies.
SLACK = 0.07


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(*text_bytes(texts), lower=True)
    h = words.hashes(BASE)
    n = len(h) - shingle + 1
    rolled = np.zeros(max(n, 0), U64)
    for k in range(shingle):
        rolled = rolled * U64(0xD6E8FEB86659FD93) + h[k : k + n] if n > 0 else rolled
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(rolled[a : b - shingle + 1]))
        elif b > a:
            short = U64(b - a)
            for x in h[a:b]:
                short = mix(np.array([short * U64(0xA24BAED4963EE407) + x], U64))[0]
            out.append(np.array([short], U64))
        else:
            out.append(np.zeros(0, U64))
    return out


def slot_of(element: np.ndarray, level: int) -> np.ndarray:
    """Place ``level`` of each element's permutation of the slots: keyed rounds, each a bijection on the slots."""
    key = mix(element ^ U64(0x5851F42D4C957F2D))
    x = np.full(len(element), level, np.uint64)
    for r in range(3):
        a = (key >> U64(18 * r)) & U64(SLOTS - 1)
        b = (key >> U64(18 * r + 9)) & U64(SLOTS - 1)
        x = (x * (a | U64(1)) + b) & U64(SLOTS - 1)
        x ^= x >> U64(3 + r % 2)
    return x.astype(np.int64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SLOTS values for each set; rows of empty sets mean nothing."""
    size = np.array([len(s) for s in sets], np.int64)
    none = np.uint32(0xFFFFFFFF)
    out = np.full(len(sets) * SLOTS, none, np.uint32)
    element = np.concatenate(sets) if len(sets) else np.zeros(0, U64)
    owner = np.repeat(np.arange(len(sets)), size)
    for level in range(SLOTS):
        if not len(element):
            break
        offer = (mix(element + U64((level + 1) * 0x2545F4914F6CDD1D % (1 << 64))) >> U64(42)).astype(np.uint32) | np.uint32(level << 22)
        np.minimum.at(out, owner * SLOTS + slot_of(element, level), offer)
        open_ = (out.reshape(-1, SLOTS) == none).any(axis=1)[owner]
        if not open_.all():
            element, owner = element[open_], owner[open_]
    return out.reshape(-1, SLOTS)


def sketch(documents: DataFrame, shingle: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n, digest and check (128 bits of the set), sig, bands of every row.  keep: further columns of longs."""
    schema = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in keep), ("n", pa.int64()), ("digest", pa.int64()), ("check", pa.int64()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch):
                sets = shingle_sets(step.column("text"), shingle)
                size = np.array([len(s) for s in sets], np.int64)
                node, check = digests(sets)
                sig = signatures(sets)
                keys = np.zeros((len(sets), BANDS), U64)
                for r in range(ROWS):
                    keys = mix(keys * U64(BASE) + sig[:, r : BANDS * ROWS : ROWS].astype(U64) + U64(1))
                keys = mix(keys + np.arange(BANDS, dtype=U64) * U64(0xD6E8FEB86659FD93)).astype(np.int64)
                short = mix(sig.astype(U64)).astype(np.uint16)
                bands = pa.ListArray.from_arrays(np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([step.column("doc_id"), *(step.column(k) for k in keep), pa.array(size), pa.array(node), pa.array(check), pa.array([x.tobytes() for x in short], pa.binary()), bands], schema=schema)

    kept = "".join(f"{k} long, " for k in keep)
    return documents.select("doc_id", "text", *keep).mapInArrow(make, f"doc_id long, {kept}n long, digest long, check long, sig binary, bands array<long>")


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as two longs."""
    out = np.zeros((2, len(sets)), U64)
    for i, s in enumerate(sets):
        if len(s):
            out[0, i] = np.add.reduce(mix(s * U64(0xC2B2AE3D27D4EB4F)))
            out[1, i] = np.add.reduce(mix(s + U64(0x165667B19E3779F9)))
    size = np.array([len(s) for s in sets], U64)
    return mix(out[0] + size).astype(np.int64), mix(out[1] ^ size).astype(np.int64)


def size_allows(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def full_sets(documents: DataFrame, classes: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """node and elements (its full set) of the needed nodes, from one more pass over the texts."""
    wanted = stored(classes.join(needed.hint("merge"), "node").select("rep", "node", "digest", "check"), "wanted")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch):
                sets = shingle_sets(step.column("text"), shingle)
                digest, check = digests(sets)
                offs = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).astype(np.int64) if len(sets) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(digest), pa.array(check), pa.ListArray.from_arrays(offs, pa.array(flat))], names=["digest", "check", "elements"])

    # the list of documents grows with the table, so it is never sent to all, however small it is here
    texts = documents.select("doc_id", "text").join(wanted.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(make, "digest long, check long, elements array<long>").join(wanted.select("node", "digest", "check").hint("merge"), ["digest", "check"])
    return sets.dropDuplicates(["node"]).select("node", "elements")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v (nodes) whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("x"), F.col("elements").alias("ex"))
    b = sets.select(F.col("node").alias("y"), F.col("elements").alias("ey"))
    joined = pairs.join(a, F.col("u") == F.col("x")).join(b, F.col("v") == F.col("y"))
    common = F.size(F.array_intersect("ex", "ey"))
    return joined.filter(common * 100 >= (F.size("ex") + F.size("ey") - common) * percent).select("u", "v")


def across_components(rows: DataFrame, sigs: DataFrame, percent: int, parts: int, top: int | None) -> DataFrame:
    """Pairs u, v of one bucket but different components that may be similar; with top only the most alike of each member in a task.

    rows: band, node, n, root; sigs: node, sig, bands.  A pair comes from the first band that it shares only.  A bucket's members of its
    largest component (main) and the others (outside) are cut into blocks of BLOCK rows; a task is a pair of blocks, main and outside or
    both outside, so it holds two blocks at most, whatever the size of the bucket.
    """
    counts = rows.groupBy("band", "root").agg(F.count("*").alias("c"))
    mixed = counts.groupBy("band").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("total"), F.count("*").alias("roots")).filter("roots > 1")
    block = lambda c: F.ceil(c / BLOCK).cast("int")
    mixed = mixed.select("band", F.col("top.root").alias("main"), block(F.col("top.c")).alias("mains"), block(F.col("total") - F.col("top.c")).alias("outsides"))
    dealt = rows.join(mixed, "band").withColumn("outside", F.col("root") != F.col("main"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("outside"), F.col("outsides")).otherwise(F.col("mains"))).cast("int"))
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    task = lambda both, a, b: F.struct(F.lit(both).alias("both"), a.cast("int").alias("a"), b.cast("int").alias("b"))
    own = F.col("own")
    across = F.when(F.col("outside"), F.transform(numbers("mains"), lambda m: task(False, m, own))).otherwise(F.transform(numbers("outsides"), lambda o: task(False, own, o)))
    # a single block of others is compared within itself where it meets the first main block
    within = F.when(F.col("outside") & (F.col("outsides") > 1), F.transform(numbers("outsides"), lambda o: task(True, F.least(own, o), F.greatest(own, o)))).otherwise(F.array())
    dealt = dealt.withColumn("task", F.explode(F.concat(across, within))).join(sigs, "node")
    names = ("band", "both", "a", "b", "outsides", "node", "n", "sig", "bands", "root", "outside", "own")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        now = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if row[:5] != now:
                    yield from compare(held, now)
                    held, now = [], row[:5]
                held.append(row[5:])
        yield from compare(held, now)

    def compare(held: list, now: tuple | None) -> Iterator[pa.RecordBatch]:
        if len(held) < 2:
            return
        band, both, a, b, outsides = now
        node, n, sig, bands, root, outside, block = zip(*held, strict=True)
        node, n, root, outside, block, bands = np.array(node), np.array(n), np.array(root), np.array(outside), np.array(block), np.array(bands)
        here = (bands == band).argmax(axis=1)  # the number of this band
        sig = np.frombuffer(b"".join(sig), np.uint16).reshape(-1, SLOTS)
        for i in np.flatnonzero(outside):
            if both:
                other = (block == b) & ((node > node[i]) | (a != b)) if block[i] == a else np.zeros(len(node), bool)
            else:
                other = ~outside | (node > node[i]) if outsides == 1 and a == 0 else ~outside
            other = other & (root != root[i]) & (np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent)
            j = np.flatnonzero(other)
            j = j[(bands[j] == bands[i]).argmax(axis=1) == here[i]]
            alike = (sig[j] == sig[i]).mean(axis=1)
            j, alike = j[alike >= percent / 100 - SLACK], alike[alike >= percent / 100 - SLACK]
            if top and len(j) > top:
                j = j[np.argsort(-alike, kind="stable")[:top]]
            if len(j):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), node[i])), pa.array(node[j])], names=["u", "v"])

    flat = dealt.select("band", "task.both", "task.a", "task.b", "outsides", "node", "n", "sig", "bands", "root", "outside", "own")
    found = flat.repartition(parts, "band", "both", "a", "b").sortWithinPartitions("band", "both", "a", "b").mapInArrow(pairs, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def set_classes(named: DataFrame) -> DataFrame:
    """digest, check, n, rep (smallest doc_id), node of each different set.  node is the digest; should two sets have one digest, the second's is made anew."""
    found = named.groupBy("digest", "check", "n").agg(F.min("doc_id").alias("rep"))
    again = F.row_number().over(Window.partitionBy("digest").orderBy("check", "n"))
    return found.withColumn("node", F.when(again == 1, F.col("digest")).otherwise(F.xxhash64("digest", "check", "n")))


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.  keep: further columns of longs."""
    parts = shuffle_partitions(documents.sparkSession)
    sketches = stored(sketch(documents, shingle, keep), "sketch")
    named = sketches.filter("n > 0 and doc_id is not null")
    classes = stored(set_classes(named), "classes")
    leads = classes.select(F.col("rep").alias("doc_id"), "digest", "check", "n", "node")
    reps = named.select("doc_id", "digest", "check", "n", "sig", "bands").join(leads, ["doc_id", "digest", "check", "n"]).dropDuplicates(["node"])
    rows = stored(reps.select("node", "n", "sig", "bands"), "nodes")
    banded = rows.select("node", "n", F.explode("bands").alias("band"))
    lead = banded.groupBy("band").agg(F.min("node").alias("v"), F.count("*").alias("c")).filter("c > 1").select("band", "v")
    # only buckets with company go on: few rows beside those of all bands
    members = stored(banded.join(lead, "band"), "members")
    sizes = rows.select(F.col("node").alias("v"), F.col("n").alias("nv"))
    star = members.filter("node != v").select(F.col("node").alias("u"), "v", "n").distinct().join(sizes, "v").filter(size_allows(F.col("n"), F.col("nv"), percent)).select(F.col("v").alias("u"), F.col("u").alias("v"))
    star = stored(star, "star")
    sets = stored(full_sets(documents, classes, members.select("node").distinct(), shingle), "sets")
    links = stored(confirmed(star, sets, percent), "links")
    labels = components(links)
    tried = star
    for top in (4, None):
        full = members.select("band", "node", "n").join(labels.select(F.col("u").alias("node"), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        more = stored(across_components(full, rows.select("node", "sig", "bands"), percent, parts, top).join(tried, ["u", "v"], "left_anti"), "more")
        if more.limit(1).count():
            links = links.unionByName(confirmed(more, sets, percent))
            labels = components(links)
        tried = tried.unionByName(more)
    rooted = classes.join(labels.select(F.col("u").alias("node"), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    found = rooted.join(least, "root").select("digest", "check", "n", "component")
    out = sketches.select("doc_id", *keep, "digest", "check", "n").join(found, ["digest", "check", "n"], "left").withColumnRenamed("n", "n_shingles")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id")))
    return out.select("doc_id", *keep, "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group stays: the smallest doc_id.  All columns as they are.

    Rows that share a doc_id are judged each by its own text: one whose text belongs to the group of a smaller doc_id goes, the others stay.
    """
    key = "__text"
    gone = near_duplicates(documents.select("doc_id", "text", F.xxhash64("text").alias(key)), shingle, percent, (key,)).filter("not kept").select("doc_id", key).distinct()
    rows = documents.select(F.struct("*").alias("row"))  # as a struct, so that no name clashes
    return rows.join(gone, (F.col("row.doc_id") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col(key)), "left_anti").select("row.*")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, percent=80)


OP6_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from d),
x as (select doc_id, len(s) as n, unnest(s) as t from s),
p as (select a.doc_id as a, b.doc_id as b, a.n + b.n as n, count(*) as c from x a join x b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2, 3),
l as (select a, b from p where 100 * c >= 80 * (n - c)), e as (select a, b from l union all select b, a from l),
r(doc_id, seen) as (select doc_id, doc_id from d union select e.b, r.seen from r join e on e.a = r.doc_id where r.seen < e.b),
c as (select doc_id, min(seen) as component_id from r group by 1)
select doc_id, len(s)::bigint as n_shingles, component_id, component_id = doc_id as kept from s join c using (doc_id)
"""
