"""Substring dedup on word windows by super-k-mer partitioning.

Every window of ``window`` consecutive words has a minimiser: the word pair with the smallest hash, the leftmost on a tie.
Consecutive windows that share one travel together, as one packed string of words, to the bucket of the minimiser, so the
text moves about three times and not ``window`` times.  Equal windows share a bucket, where sorting their fingerprints
finds for each the smallest doc_id.  A word is removed if a window that covers it also starts in a document with a
smaller doc_id.  Windows are judged on the input, not on what is left.

Skew: a step (a few MB of documents) sends a packed string only once, for its smallest doc_id; the other documents of the
step are marked there and then, so copies by the thousand shrink before the shuffle.  Word pairs that would be
the minimiser of more than their share of windows (counted over all documents, with a guaranteed error, see
``heavy_pairs``) are chosen last, so that rare neighbours spread their windows over the buckets.

Edge cases: null and empty texts have no words; texts shorter than a window lose nothing; a row without doc_id can't be
ordered, keeps all its words and takes none from others; rows that repeat a doc_id are one document for the order; a very long text makes a
step of its own, its places have 32 bits; an empty table gives an empty result; other columns are ignored, whatever their names.

Windows are equal if two 64-bit fingerprints are, which rest on multilinear word hashes with independent factors (see common.hash_slices): no
two contents collide by their form, and by chance with less than 2 ** -100 a pair.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packed
from .common import U64, Words, mix, read_table, ranges, shuffle_partitions, sliding_min, text_bytes, text_keys, text_steps, words_of

BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
LAST = U64(1) << U64(63)
#: Low bits of a rank: the place in the step, so that the smallest value tells where; the 31 above it order by the pair's hash.  A step has fewer than
#: 2 ** 31 words, and equal windows choose alike at any width.
PLACE_BITS = U64(32)


def pair_hashes(words: Words) -> np.ndarray:
    h = words.hashes(BASE_A)
    return mix(h[:-1] * U64(0xA24BAED4963EE407) + h[1:]) if len(h) > 1 else h[:0]


def minimisers(words: Words, window: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: first word, number of windows, document in the step, the pair's hash."""
    none = np.zeros(0, np.int64)
    n = len(words)
    if n < window:
        return none, none, none, none.astype(U64)
    pairs = pair_hashes(words)
    rank = pairs >> U64(1)
    if len(last):
        at = np.minimum(np.searchsorted(last, pairs), len(last) - 1)
        rank = np.where(last[at] == pairs, rank | LAST, rank)
    rank = (rank >> PLACE_BITS << PLACE_BITS) | np.arange(len(pairs), dtype=U64)
    place = (sliding_min(rank, window - 1) & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    doc = words.doc()
    valid = doc[: n - window + 1] == doc[window - 1 :]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1]) | (doc[1 : n - window + 1] != doc[: n - window])
    first = np.flatnonzero(new)
    upto = np.cumsum(valid)
    count = np.diff(np.concatenate([upto[first] - 1, upto[-1:]]))
    return first, count, doc[first], pairs[place[first]]


def heavy_pairs(documents: DataFrame, window: int, share: float) -> np.ndarray:
    """Hashes of the word pairs that are minimisers of more than ``share`` of all super-k-mers.

    Each step drops what is below share / 8 of it and each task what is below share / 2 of it, so at least a quarter of
    the count of such a pair arrives and it is found for certain; at most 2 / share pairs of each task are sent and
    4 / share pairs reach the driver, however large the table is.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        total = 0
        none = np.zeros(0, U64)
        for batch in batches:
            for step in text_steps(batch):
                data, offs = text_bytes(step.column("text"))
                pairs, n = np.unique(minimisers(words_of(data, offs), window, none)[3], return_counts=True)
                total += int(n.sum())
                big = n > max(1, share / 8 * n.sum())
                seen.update(dict(zip(pairs[big].tolist(), n[big].tolist(), strict=True)))
        keep = [(int(np.uint64(k).astype(np.int64)), v, total) for k, v in seen.items() if v > share / 2 * total]
        keep.append((0, 0, total))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*keep, strict=True)], names=["pair", "n", "total"])

    found = documents.select("text").mapInArrow(count, "pair long, n long, total long")
    counts = found.groupBy("pair").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("n") == 0, F.col("total"))).alias("total"))
    rows = counts.orderBy(F.desc("n")).limit(int(4 / share) + 1).collect()
    total = sum(r.total or 0 for r in rows if r.n == 0) or documents.count()
    return np.sort(np.array([r.pair for r in rows if r.n > share / 4 * total], np.int64).astype(U64))


def first_windows(documents: DataFrame, window: int, buckets: int, last: np.ndarray) -> DataFrame:
    """Stretches of words to remove, as rows of packed.PART."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch):
                data, offs = text_bytes(step.column("text"))
                words = words_of(data, offs)
                first, count, doc, minimiser = minimisers(words, window, last)
                if not len(first):
                    continue
                ids = step.column("doc_id").to_numpy(zero_copy_only=False)[doc]
                keys = text_keys(data, offs)[doc]
                end = words.start[first + count + window - 2] + words.length[first + count + window - 2]
                length = end - words.start[first]
                # the same string twice in this step: only the smallest doc_id has to travel
                same = same_strings(words, first, count + window - 1)
                order = np.lexsort((ids, same))
                lead = np.ones(len(order), bool)
                lead[1:] = same[order][1:] != same[order][:-1]
                owner = np.empty(len(order), np.int64)
                owner[order] = ids[order][np.flatnonzero(lead)[np.cumsum(lead) - 1]]
                late = ids > owner
                entries = {"doc": ids, "key": keys, "start": first - words.first[doc], "windows": count, "length": length, "minimiser": minimiser}
                # what is already decided goes along without its text, marked by windows < 0
                entries["windows"] = np.where(late, -count, count)
                entries["length"] = np.where(late, 0, length)
                yield from packed.pack(entries, words.data, words.start[first], buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, data = packed.unpack(batches)
        if not len(entries["doc"]):
            return
        done = entries["windows"] < 0
        doc, key, begin, end = [entries["doc"][done]], [entries["key"][done]], [entries["start"][done]], [(entries["start"] - entries["windows"] + window - 1)[done]]
        live = {k: v[~done] for k, v in entries.items()}
        offs = np.concatenate([[0], np.cumsum(live["length"], dtype=np.int64)])
        words = words_of(data, offs)
        a, b = words.hashes(BASE_A), words.hashes(BASE_B)
        at = ranges(words.first[:-1], live["windows"].astype(np.int64))
        entry = np.repeat(np.arange(len(live["doc"])), live["windows"])
        fa, fb = np.zeros(len(at), U64), np.zeros(len(at), U64)
        for k in range(window):
            fa = fa * U64(BASE_B) + a[at + k]
            fb = fb * U64(BASE_A) + b[at + k]
        fa = mix(fa)
        order = np.argsort(fa)
        sa, sb = fa[order], fb[order]
        bad = (sa[1:] == sa[:-1]) & (sb[1:] != sb[:-1])
        if bad.any():  # two windows with one 64-bit fingerprint: order by all 128 bits
            order = np.lexsort((fb, fa))
            sa, sb = fa[order], fb[order]
        lead = np.ones(len(order), bool)
        lead[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
        docs = live["doc"][entry[order]]
        heads = np.flatnonzero(lead)
        if len(heads):
            least = np.minimum.reduceat(docs, heads)[np.cumsum(lead) - 1]
            gone = np.zeros(len(order), bool)
            gone[order] = docs > least
            x, y = packed.runs(gone, entry)
            e = entry[x]
            base = at - words.first[:-1][entry]
            doc.append(live["doc"][e])
            key.append(live["key"][e])
            begin.append(live["start"][e] + base[x])
            end.append(live["start"][e] + base[y] + window)
        yield from packed.removals(np.concatenate(doc), np.concatenate(key), np.concatenate(begin), np.concatenate(end), buckets)

    sent = documents.select("doc_id", "text").filter("doc_id is not null").mapInArrow(send, packed.BLOB)
    return sent.repartitionById(buckets, F.col("bucket")).mapInArrow(count, packed.PART)


def same_strings(words: Words, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For runs of words a number each: the same for the same string of words (128 bits decide)."""
    out = []
    for base in (BASE_A, BASE_B):
        h = words.hashes(base)
        lift = np.cumprod(np.full(len(h) + 1, base, U64))
        total = np.concatenate([np.zeros(1, U64), np.cumsum(h * lift[:-1])])
        # the sum over a run, brought to a common power, is the same wherever the run lies
        out.append((total[first + count] - total[first]) * lift[len(h) - first])
    order = np.lexsort((count, out[1], out[0]))
    change = np.zeros(len(order), bool)
    change[:1] = True
    for x in (out[0], out[1], count):
        s = x[order]
        change[1:] |= s[1:] != s[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(change)
    return number


def substring_dedup(documents: DataFrame, window: int = 13, buckets: int | None = None, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with keep_text, the kept words joined by one blank, of every document."""
    spark = documents.sparkSession
    buckets = buckets or 2 * shuffle_partitions(spark)
    last = heavy_pairs(documents, window, 1 / (4 * buckets))
    removed = first_windows(documents, window, buckets, last)

    def apply(step: pa.RecordBatch, spans: packed.Spans) -> pa.RecordBatch:
        data, offs = text_bytes(step.column("text"))
        words, keys = words_of(data, offs), text_keys(data, offs)
        rows = []
        for i, doc in enumerate(step.column("doc_id").to_pylist()):
            a, b = int(words.first[i]), int(words.first[i + 1])
            keep = words.data[words.start[a] : words.start[b - 1] + words.length[b - 1]] if b > a else words.data[:0]
            flags = spans.flags(doc, int(keys[i]), b - a)
            if flags is not None:
                left = a + np.flatnonzero(~flags)
                keep = packed.take_slices(words.data, words.start[left], words.length[left] + 1)[:-1]
            raw = keep.tobytes()
            rows.append((doc, b - a, 0 if flags is None else int(flags.sum()), hashlib.sha256(raw).hexdigest(), *([raw.decode("utf-8", "replace")] if keep_text else [])))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.string())] if keep_text else [])])
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text
    return packed.with_removals(documents, removed, buckets, apply, schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"), keep_text=False)


OP5_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
x as (select doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i : i + 12], ' '))) as s, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13),
m as (select s, min(doc_id) as f from x group by s),
r as (select distinct doc_id, unnest(range(i, i + 13)) as k from x join m using (s) where f < doc_id),
k as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from d),
g as (select k.doc_id, count(*) filter (r.k is not null) as gone, string_agg(case when r.k is null then word end, ' ' order by k.k) as kept from k left join r on r.doc_id = k.doc_id and r.k = k.k group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(gone, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join g using (doc_id)
"""
