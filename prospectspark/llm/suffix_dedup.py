"""Substring dedup on bytes with a logarithmic family of suffix arrays.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller
doc_id, or in the same one further left.  Strings are judged on the input; matches never cross documents.

Sparse suffixes.  Not all of the corpus' suffixes are indexed: each window of ``length`` bytes has a minimiser, the
``gram`` bytes with the smallest hash in it, and a window can only match where the same gram is.  Windows with a common
minimiser travel as one string to the bucket of the gram (packed.py).  In the bucket, strings whose gram is unique are
done, repeated strings keep their first copy (found by a hash, then compared byte for byte), and only the rest gets suffix arrays.

Family.  A bucket's strings, in order of (doc_id, start), come in batches.  A batch gets the sorted array of its suffixes
(the window starts), ordered by the Karp-Rabin fingerprint of their first ``length`` bytes: only equality over that length
matters, and it keeps a merge to one sorted pass.  The array is merge-scanned against the existing levels, every match is
compared byte for byte, and what is new becomes a level; levels of like size merge, so k batches leave log k levels.

Skew: within a step of a few MB, a string is sent once and its later copies are marked there, so groups of copies
shrink before the shuffle.

Edge cases: null and empty texts have no bytes; texts shorter than ``length`` lose nothing; a row without doc_id can't be
ordered, keeps all and takes nothing from others; rows that repeat doc_id and text stand at one place and don't remove
each other, with another text they follow in order of their CRC-32; a very long text makes a step of its own, its places have 32 bits; of
tied minimisers the leftmost counts; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed
from .common import STEP_BYTES, U64, hash_slices, mix, ranges, read_table, shuffle_partitions, sliding_min, text_bytes, text_keys, text_steps

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407, 0xC2B2AE3D27D4EB4F)
GRAM = 16
#: Low bits of a rank: the place in the step, which any text that Spark can hold (under 2 ** 31 bytes) fits; equal windows choose alike at any width.
PLACE_BITS = U64(32)
BATCH_WINDOWS = 1 << 20


def gram_hashes(data: np.ndarray, width: int, base: int) -> np.ndarray:
    """A polynomial hash of each ``width`` neighbouring bytes, built from hashes of half the width."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, have, power, size, factor = None, 0, data.astype(U64) + U64(1), 1, pow(base, 1, 1 << 64)
    while True:
        if width & size:  # append this block behind what is there
            out = power[:n] if out is None else out * U64(factor) + power[have : have + n]
            have += size
        if have == width:
            return out
        power = power[:-size] * U64(factor) + power[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)


def minimisers(data: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: first byte, number of windows, document in the step, the gram's hash."""
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, none.astype(U64)
    grams = mix(gram_hashes(data, gram, BASES[0]))
    rank = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=U64)
    place = (sliding_min(rank, length - gram + 1) & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    upto = np.diff(offs)
    fits = np.maximum(upto - length + 1, 0)
    starts = np.zeros(len(data) + 1, np.int32)
    has = fits > 0
    starts[offs[:-1][has]] += 1
    starts[offs[:-1][has] + fits[has]] -= 1
    valid = np.cumsum(starts[:n]) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    begins = offs[:-1][has]
    new[begins[begins < n]] = True
    first = np.flatnonzero(new)
    doc = np.searchsorted(offs, first, side="right") - 1
    end = np.minimum(np.concatenate([first[1:], [len(data)]]), offs[:-1][doc] + fits[doc])
    return first, end - first, doc, grams[place[first]]


class SuffixFamily:
    """Levels of suffix arrays over ``data``: sorted fingerprints of the strings of ``length`` bytes at ``place``."""

    def __init__(self, data: np.ndarray, length: int, base: int):
        self.data, self.length, self.base = data, length, base
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, place: np.ndarray) -> np.ndarray:
        """Index the suffixes at these ascending places; flags for those whose string starts at a smaller place too."""
        a, b = int(place[0]), int(place[-1]) + self.length
        prints = mix(gram_hashes(self.data[a:b], self.length, self.base))[place - a]
        order = np.argsort(prints)
        prints, at = prints[order], place[order]
        head = np.ones(len(at), bool)
        head[1:] = prints[1:] != prints[:-1]
        group = np.cumsum(head) - 1
        heads = np.flatnonzero(head)
        first = np.minimum.reduceat(at, heads)
        self.verify(at, first[group])
        prints, seen = prints[heads], np.zeros(len(heads), bool)
        for level, places in self.levels:
            spot = np.minimum(np.searchsorted(level, prints), len(level) - 1)
            hit = level[spot] == prints
            self.verify(first[hit], places[spot[hit]])
            seen |= hit
        found = np.empty(len(place), bool)
        found[order] = seen[group] | (at != first[group])
        self.push(prints[~seen], first[~seen])
        return found

    def push(self, prints: np.ndarray, places: np.ndarray) -> None:
        if not len(prints):
            return
        while self.levels and len(self.levels[-1][0]) < 2 * len(prints):
            other, at = self.levels.pop()
            prints, places = np.concatenate([other, prints]), np.concatenate([at, places])
            order = np.argsort(prints, kind="stable")  # two sorted runs: one merge
            prints, places = prints[order], places[order]
        self.levels.append((prints, places))

    def verify(self, x: np.ndarray, y: np.ndarray) -> None:
        """Compare the strings at x and y byte for byte; of neighbours that go on together only the next byte."""
        differs = x != y
        x, y = x[differs], y[differs]
        order = np.argsort(x)
        x, y = x[order], y[order]
        goes_on = np.zeros(len(x), bool)
        goes_on[1:] = (x[1:] - x[:-1] == 1) & (y[1:] - y[:-1] == 1)
        last = self.length - 1
        same = (self.data[x[goes_on] + last] == self.data[y[goes_on] + last]).all()
        whole = np.flatnonzero(~goes_on)
        span = np.arange(self.length)
        for k in range(0, len(whole), 1 << 15):
            i = whole[k : k + (1 << 15)]
            same &= (self.data[x[i, None] + span] == self.data[y[i, None] + span]).all()
        if not same:
            raise Collision


class Collision(Exception):
    """Two different strings have one fingerprint; the bucket is done again with another base."""


def repeated(entries: dict[str, np.ndarray], data: np.ndarray, length: int, base: int, batch: int = BATCH_WINDOWS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches (doc, key, begin, end) of the entries that start earlier too."""
    offs = np.concatenate([[0], np.cumsum(entries["length"], dtype=np.int64)])
    order = np.lexsort((entries["start"], entries["key"], entries["doc"]))
    place = {k: entries[k][order] for k in ("doc", "key", "start")}
    new = np.ones(len(order), bool)
    new[1:] = (place["doc"][1:] != place["doc"][:-1]) | (place["key"][1:] != place["key"][:-1]) | (place["start"][1:] != place["start"][:-1])
    order = order[new]  # rows that repeat stand at one place
    # strings whose gram is unique in the bucket are done; of equal strings the first stays
    gram = entries["minimiser"][order]
    _, number, count = np.unique(gram, return_inverse=True, return_counts=True)
    order = order[count[number] > 1]
    if not len(order):
        return
    length_ = entries["length"].astype(np.int64)
    _, lead, number = np.unique(hash_slices(data, offs[:-1], length_, base)[order], return_index=True, return_inverse=True)
    copy = lead[number] != np.arange(len(order))
    e = order[copy]
    if not same_bytes(data, offs[:-1][e], length_[e], offs[:-1][order[lead[number]][copy]], length_[order[lead[number]][copy]]):
        raise Collision
    yield entries["doc"][e], entries["key"][e], entries["start"][e], entries["start"][e] + entries["length"][e]
    order = order[~copy]
    _, number, count = np.unique(entries["minimiser"][order], return_inverse=True, return_counts=True)
    order = order[count[number] > 1]
    if not len(order):
        return
    size = entries["length"][order].astype(np.int64)
    text = packed.take_slices(data, offs[:-1][order], size)
    begin = np.cumsum(size) - size
    windows = entries["windows"][order].astype(np.int64)
    family = SuffixFamily(text, length, base)
    cut = (np.cumsum(windows) - 1) // batch
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(order)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        at = ranges(begin[a:b], windows[a:b])
        owner = np.repeat(np.arange(a, b), windows[a:b])
        x, y = packed.runs(family.add(at), owner)
        e, base_at = order[owner[x]], begin[owner[x]]
        yield entries["doc"][e], entries["key"][e], entries["start"][e] + at[x] - base_at, entries["start"][e] + at[y] - base_at + length


def earlier_strings(documents: DataFrame, length: int, gram: int, buckets: int, batch: int) -> DataFrame:
    """Stretches of bytes to remove, as rows of packed.PART."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for step in text_steps(given):
                data, offs = text_bytes(step.column("text"))
                first, count, doc, minimiser = minimisers(data, offs, length, gram)
                if not len(first):
                    continue
                ids = step.column("doc_id").to_numpy(zero_copy_only=False)[doc]
                keys, start, size = text_keys(data, offs)[doc], first - offs[:-1][doc], count + length - 1
                same = same_strings(data, first, size)
                order = np.lexsort((start, keys, ids, same))
                lead = np.ones(len(order), bool)
                lead[1:] = same[order][1:] != same[order][:-1]
                owner = np.empty(len(order), np.int64)
                owner[order] = order[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
                late = (ids != ids[owner]) | (keys != keys[owner]) | (start != start[owner])
                entries = {"doc": ids, "key": keys, "start": start, "windows": np.where(late, -count, count), "length": np.where(late, 0, size), "minimiser": minimiser}
                yield from packed.pack(entries, data, first, buckets, packed.WITH_MINIMISER)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, data = packed.unpack(batches, packed.WITH_MINIMISER)
        done = entries["windows"] < 0
        yield from packed.removals(entries["doc"][done], entries["key"][done], entries["start"][done], (entries["start"] - entries["windows"] + length - 1)[done], buckets)
        live = {k: v[~done] for k, v in entries.items()}
        for base in BASES:
            try:
                found = list(repeated(live, data, length, base, batch))
            except Collision:
                continue
            if found:
                yield from packed.removals(*(np.concatenate(x) for x in zip(*found, strict=True)), buckets)
            return
        raise ArithmeticError("fingerprints collide for every base")

    sent = documents.select("doc_id", "text").filter("doc_id is not null").mapInArrow(send, packed.BLOB)
    return sent.repartitionById(buckets, F.col("bucket")).mapInArrow(find, packed.PART)


def same_bytes(data: np.ndarray, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> bool:
    """Whether each slice of nx bytes at x has the content of that of ny bytes at y."""
    if not np.array_equal(nx, ny):
        return False
    step = (np.cumsum(nx) - 1) // STEP_BYTES  # a few MB at a time
    edges = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(x)]
    return all(np.array_equal(packed.take_slices(data, x[a:b], nx[a:b]), packed.take_slices(data, y[a:b], nx[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True))


def same_strings(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For slices a number each: the same for the same bytes.  Sums of powers find them, bytes decide."""
    for base in BASES:
        lift = np.cumprod(np.full(len(data) + 1, base, U64))
        total = np.concatenate([np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * lift[:-1])])
        print_ = (total[first + size] - total[first]) * lift[len(data) - first]
        _, lead, number = np.unique(mix(print_ ^ mix(size.astype(U64))), return_index=True, return_inverse=True)
        copy = np.flatnonzero(lead[number] != np.arange(len(first)))
        if same_bytes(data, first[copy], size[copy], first[lead[number[copy]]], size[lead[number[copy]]]):
            return number
    # texts made to collide: compare them all
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(data[a : a + n].tobytes(), len(seen)) for a, n in zip(first.tolist(), size.tolist(), strict=True)], np.int64)


def suffix_dedup(documents: DataFrame, length: int = 100, gram: int = GRAM, buckets: int | None = None, batch: int = BATCH_WINDOWS, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with keep_bytes, the remaining bytes of every document."""
    gram = min(gram, length)
    buckets = buckets or 2 * shuffle_partitions(documents.sparkSession)
    removed = earlier_strings(documents, length, gram, buckets, batch)

    def apply(step: pa.RecordBatch, spans: packed.Spans) -> pa.RecordBatch:
        data, offs = text_bytes(step.column("text"))
        keys = text_keys(data, offs)
        rows = []
        for i, doc in enumerate(step.column("doc_id").to_pylist()):
            own = data[offs[i] : offs[i + 1]]
            n, gone, pieces = len(own), 0, 0
            flags = spans.flags(doc, int(keys[i]), n)
            if flags is not None:
                gone = int(flags.sum())
                pieces = int(flags[:1].sum() + (flags[1:] & ~flags[:-1]).sum())
                own = own[~flags]
            raw = own.tobytes()
            rows.append((doc, n, gone, pieces, hashlib.sha256(raw).hexdigest(), *([raw] if keep_bytes else [])))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.binary())] if keep_bytes else [])])
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return packed.with_removals(documents, removed, buckets, apply, schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"), keep_bytes=False)
