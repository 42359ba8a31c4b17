"""Best-fit packing of documents into training sequences by a grouping genetic algorithm.

A document's ids (its text's, then one end id) are cut into pieces of ``capacity`` only if there are more; the first piece takes the rest.
Full pieces are sequences of their own, the other pieces are packed.

Grouping genes: an individual is a set of bins.  Crossover injects whole well-filled bins of one parent into the other, removes the
bins that hold an injected item twice, and puts the displaced items back by best fit, longest first; mutation dissolves the
worst bins.  Pieces are dealt by a hash into groups of about GROUP; each group is evolved on ISLANDS islands, which are
tasks of their own; after an epoch each island's elite migrates to the next island, and after the last the best island's
bins are taken.  Bins that are filled to ``settled`` stay; the pieces of all others go to the next level, in fewer groups, where they
meet those of other groups, until one group is left or nothing improves.  A level needs two shuffles of (item, length) rows only; texts and ids never move.

Seeds come from the group, island and epoch, items are sorted first, so reruns give the same sequences.

Edge cases: null and empty texts are one end id; a very long text is cut into full pieces and a first one with the rest; pieces of equal length
are taken in order of their item number; rows that repeat a doc_id, or have none, are packed each; texts with the vocabulary's special
token are encoded as the tokenizer's own library does; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import random
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored, text_steps

CAPACITY = 2048
END_ID = 0
GROUP = 2048
ISLANDS = 2
POPULATION, GENERATIONS = 4, 5
PIECES = "item long, doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def encoder(path: str):
    """A function from texts to lists of ids, for a byte-level BPE file of the tokenizers library.

    tiktoken gives the same ids in a quarter of the time when the vocabulary's order is the order of merges, which is checked; texts with a
    special token's string go to the library itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    library = Tokenizer.from_file(path)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    # the byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from 256 on
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    joined = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if joined != sorted(joined):
        return lambda texts: [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [library.encode(t, add_special_tokens=False).ids if any(s in t for s in special) else fast.encode_ordinary(t) for t in texts]

    return encode


def pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for step in text_steps(batch):
                out = []
                for doc, ids in zip(step.column("doc_id").to_pylist(), encode([t or "" for t in step.column("text").to_pylist()]), strict=True):
                    ids = np.array([*ids, end_id], "<u4")
                    edges = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
                    out += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- one island ------------------------------------------------------------------------------------------------------


def best_fit(bins: list[list[int]], items: list[int], size: list[int], capacity: int) -> list[list[int]]:
    """Put each item where the least room is left; bit r of ``free`` is set if a bin has r left."""
    room: dict[int, list[int]] = {}
    free = 0
    for b, own in enumerate(bins):
        r = capacity - sum([size[i] for i in own])
        room.setdefault(r, []).append(b)
        free |= 1 << r
    for i in items:
        s = size[i]
        fits = free >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            own = room[r]
            b = own.pop()
            if not own:
                free &= ~(1 << r)
            bins[b].append(i)
        else:
            b, r = len(bins), capacity
            bins.append([i])
        room.setdefault(r - s, []).append(b)
        free |= 1 << (r - s)
    return bins


def fills(bins: list[list[int]], size: list[int]) -> list[int]:
    return [sum([size[i] for i in b]) for b in bins]


def worth(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins of more unequal fill, which leave room."""
    return -len(bins), sum((f / capacity) ** 2 for f in fills(bins, size))


def crossover(a: list[list[int]], b: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    order = sorted(zip(fills(a, size), range(len(a)), strict=True), reverse=True)
    chosen = [a[k] for _, k in order[: max(1, len(order) // 2)] if rng.random() < 0.6] or [a[order[0][1]]]
    injected = {i for own in chosen for i in own}
    child, displaced = [list(own) for own in chosen], []
    for own in b:
        if injected.isdisjoint(own):
            child.append(list(own))
        else:
            displaced += [i for i in own if i not in injected]
    return best_fit(child, sorted(displaced, key=lambda i: (-size[i], i)), size, capacity)


def mutation(bins: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    order = sorted(zip(fills(bins, size), range(len(bins)), strict=True))
    gone = {k for _, k in order[: max(1, len(order) // 10)]} | {rng.randrange(len(bins))}
    displaced = [i for k in gone for i in bins[k]]
    displaced.sort(key=lambda i: (-size[i] * rng.uniform(0.8, 1.2), i))
    return best_fit([list(own) for k, own in enumerate(bins) if k not in gone], displaced, size, capacity)


def evolve(size: list[int], capacity: int, given: list[list[list[int]]], rng: random.Random, population: int = POPULATION, generations: int = GENERATIONS) -> list[list[int]]:
    """The best individual after some generations that start from ``given``."""
    least = -(-sum(size) // capacity)
    falling = sorted(range(len(size)), key=lambda i: (-size[i], i))
    people = [[list(b) for b in g] for g in given] or [best_fit([], falling, size, capacity)]
    while len(people) < population:
        people.append(best_fit([], sorted(falling, key=lambda i: -size[i] * rng.uniform(0.7, 1.3)), size, capacity))
    people.sort(key=lambda p: worth(p, size, capacity), reverse=True)
    for _ in range(generations):
        if len(people[0]) <= least:
            break
        for _ in range(population):
            a, b = rng.sample(people[: population], 2)
            child = crossover(a, b, size, capacity, rng)
            if rng.random() < 0.5:
                child = mutation(child, size, capacity, rng)
            people.append(child)
        people = sorted(people, key=lambda p: worth(p, size, capacity), reverse=True)[:population]
    return people[0]


# --- islands as Spark tasks ------------------------------------------------------------------------------------------


def epoch(rows: DataFrame, capacity: int, number: int) -> DataFrame:
    """rows: grp, island, item, length, bin, origin (who made the bins, null before the first epoch)."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["origin", "item"], kind="stable")
        base = frame[frame["origin"] == frame["origin"].iloc[0]]
        item, size = base["item"].to_numpy(), base["length"].astype(int).tolist()
        given = []
        if number:
            for _, own in frame.groupby("origin", sort=True):
                bins: dict[int, list[int]] = {}
                for i, b in enumerate(own["bin"].tolist()):
                    bins.setdefault(b, []).append(i)
                given.append(list(bins.values()))
        best = evolve(size, capacity, given, random.Random(f"{key[0]}-{key[1]}-{number}"))
        bin_ = np.empty(len(item), np.int32)
        offset = np.empty(len(item), np.int64)
        fill = np.empty(len(item), np.int64)
        for b, own in enumerate(best):
            at = 0
            for i in own:
                bin_[i], offset[i] = b, at
                at += size[i]
            fill[own] = at
        return pd.DataFrame({"grp": key[0], "island": key[1], "item": item, "length": size, "bin": bin_, "origin": key[1], "offset": offset, "fill": fill, "bins": len(best)})

    return rows.groupBy("grp", "island").applyInPandas(run, "grp long, island int, item long, length long, bin int, origin int, offset long, fill long, bins int")


def evolve_groups(items: DataFrame, groups: int, capacity: int, level: int) -> DataFrame:
    """grp, item, length, bin, offset, fill of the best island of each group."""
    grp = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups))
    rows = items.select(grp.alias("grp"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "item", "length", F.lit(0).alias("bin"), F.lit(-1).alias("origin"))
    first = stored(epoch(rows, capacity, 0), "islands")
    moved = first.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"))
    cols = ["grp", "island", "item", "length", "bin", "origin"]
    second = stored(epoch(first.select(cols).unionByName(moved.select(cols)), capacity, 1), "islands")
    best = second.groupBy("grp").agg(F.min(F.struct("bins", "island")).alias("top")).select("grp", F.col("top.island").alias("island"))
    return second.join(best, ["grp", "island"])


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, settled: float = 0.995) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = stored(pieces(documents, tokenizer, capacity, end_id).withColumn("item", F.monotonically_increasing_id()), "pieces")
    items = cut.filter(F.col("length") < capacity).select("item", "length")
    left, level, placed = items.count(), 0, None
    while left:
        groups = max(1, left // GROUP)
        made = stored(evolve_groups(items, groups, capacity, level), "packed")
        sequence = F.lit(level << 56) + F.col("grp") * (1 << 24) + F.col("bin")
        done = F.lit(True) if groups == 1 else F.col("fill") >= int(settled * capacity)
        stays = made.filter(done).select("item", sequence.alias("sequence_id"), "offset")
        placed = stays if placed is None else placed.unionByName(stays)
        items = made.filter(~done).select("item", "length")
        before, left, level = left, items.count(), level + 1
        if left > 0.9 * before:  # no good bins can be made of these lengths: they stay as they are
            placed = placed.unionByName(made.filter(~done).select("item", sequence.alias("sequence_id"), "offset"))
            break
    whole = cut.filter(F.col("length") >= capacity).select("*", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = cut.filter(F.col("length") < capacity)
    rest = rest.join(placed, "item") if placed is not None else rest.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(rest).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), default_tokenizer())
