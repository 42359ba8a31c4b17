"""Spelling variants: words of the corpus that differ by one inserted, deleted or replaced character, and the common form behind them.

The one error of a pair lies in the right or in the left half of a word.  So one half is matched exactly in an FM-index over the delimited
vocabulary and the match is extended across the other half, allowing one error, until the delimiter; the intervals of suffix ranks tell which
characters can follow at all.  The index is kept in both directions: with that of the text a match grows to the left, with that of the reversed
text to the right.  Neither scheme ever turns round, so only the interval of its own direction is carried.

Distribution: a word is sought among the words that share its exact half.  The half is the key of the exchange, so each task indexes the words of
its keys (each word under the two half lengths that its neighbours can have) and searches its own words there; no task sees the whole vocabulary.
A half that more than ``block`` words share is dealt over blocks, each with an index of its own, and its words are sought in every block.  A pair
found from the right half is counted only if its left halves differ, so that each pair is found once.

Edge cases: null texts have no words; a row without doc_id counts, with the empty string as its doc_id; rows that repeat a doc_id count each;
texts and words may be of any length (a search takes as many vectorised steps as the longest word of a task has characters); ties between forms go
to the smallest word in code-point order; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranges, read_table, shuffle_partitions, stored, text_bytes, text_steps

#: Different words that a task counts before it hands its counts on.
COUNTED = 300_000
#: Words that are sought at a time.
SOUGHT = 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def count_words(documents: DataFrame, min_length: int, min_count: int, slip: int | None) -> DataFrame:
    """word, n: runs of letters (A-Z lower-cased) with at least ``min_length`` code points and ``min_count`` occurrences.

    slip: where the CRC-32 of "doc_id:run" is a multiple of it, the run loses one code point, as a writer's slip would take it.
    """
    find = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}").findall
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for step in text_steps(batch):
                data, offs = text_bytes(step.column("text"))
                data = memoryview(_LOWER[data])
                for doc, a, b in zip(step.column("doc_id").to_pylist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                    seed = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                    for run, n in Counter(find(str(data[a:b], "utf-8"))).items():
                        if slip and (h := zlib.crc32(run.encode(), seed)) % slip == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_length:
                                continue
                        total[run] += n
                if len(total) >= COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)
                    total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)

    counts = documents.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- the index -------------------------------------------------------------------------------------------------------


class Index:
    """An FM-index of words, each between delimiters, in which a match grows by one character to the right."""

    def __init__(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray):
        """codes: characters from 1 on; start, length: of each word in codes."""
        m = len(start)
        self.first = np.cumsum(length + 1) - length  # where the reversed words begin in the text
        size = int(length.sum()) + m + 1
        text = np.zeros(size, np.int64)
        at = ranges(start, length)
        text[np.repeat(self.first + length - 1 + start, length) - at] = codes[at]
        self.size, self.words = size, m
        self.suffix = suffixes(text, m + 1)
        last = text[self.suffix - 1]
        order = np.argsort(last.astype(np.int32), kind="stable")
        self.keys = last[order] * size + order
        self.last = last

    def step(self, code: np.ndarray | int, rank: np.ndarray) -> np.ndarray:
        """The rank that bounds the match after it has grown by the character."""
        return np.searchsorted(self.keys, code * self.size + rank)

    def whole(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the matches that began at a delimiter end at one too, and their words."""
        a, b = self.step(0, low), self.step(0, high)
        hit = np.flatnonzero(b > a)
        place = self.suffix[self.keys[a[hit]]]
        own = place > 0  # the text's first delimiter follows its last one, not a word
        return hit[own], np.searchsorted(self.first, place[own])


def suffixes(text: np.ndarray, delimiters: int) -> np.ndarray:
    """Places in the order of the suffixes there, by doubling; the delimiters (0) differ from each other by their places."""
    size = len(text)
    rank = text + (delimiters - 1)
    rank[text == 0] = np.arange(delimiters)
    width = 1
    while True:
        key = rank * (size + 1)
        key[: size - width] += rank[width:] + 1
        order = np.argsort(key)
        new = np.zeros(size, np.int64)
        ordered = key[order]
        np.cumsum(ordered[1:] != ordered[:-1], out=new[1:])
        rank = np.empty(size, np.int64)
        rank[order] = new
        if new[-1] == size - 1:
            return order
        width *= 2


def pairs_within(index: Index, codes: np.ndarray, start: np.ndarray, length: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """query, word: words of the index that have the query's first ``half`` characters and differ from it by one error after them."""
    none = np.zeros(0, np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def at(query: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        return codes[start[query] + place]

    def grown(query: np.ndarray, low: np.ndarray, high: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The matches after their queries' character at ``place``; those at the end of their query are whole or gone."""
        ends = length[query] == place
        if ends.any():
            hit, word = index.whole(low[ends], high[ends])
            found.append((query[ends][hit], word))
            query, low, high = query[~ends], low[~ends], high[~ends]
        code = at(query, place)
        low, high = index.step(code, low), index.step(code, high)
        on = high > low
        return query[on], low[on], high[on]

    exact = np.arange(len(start))
    low, high = np.zeros(len(start), np.int64), np.full(len(start), index.words + 1)
    replaced = inserted = dropped = (none, none, none)
    for depth in range(int(length.max(initial=0)) + 2):
        # one character of the query is left out: the last of a run of equal ones
        open_ = exact[(half[exact] <= depth) & (depth < length[exact])]
        run = depth + 1 < length[open_]
        run[run] = at(open_[run], depth) == at(open_[run], depth + 1)
        keep = np.isin(exact, open_[~run], assume_unique=True)
        dropped = tuple(np.concatenate(x) for x in zip(dropped, (exact[keep], low[keep], high[keep]), strict=True))
        # another character in place of, or before, the one at this depth: what follows a match is the same for all queries that share it
        more = half[exact] <= depth
        query, node, row = exact[more], *np.unique(low[more], return_inverse=True)
        fresh = (none, none, none, none)
        if len(query):
            width = np.zeros(len(node), np.int64)
            width[row] = (high - low)[more]
            alphabet = int(index.last.max()) + 1
            key = np.unique(np.repeat(np.arange(len(node)), width) * alphabet + index.last[ranges(node, width)])
            key = key[key % alphabet > 0]
            owner, code = np.divmod(key, alphabet)
            child_low, child_high = index.step(code, node[owner]), index.step(code, (node + width)[owner])
            n = np.bincount(owner, minlength=len(node))
            child = ranges((np.cumsum(n) - n)[row], n[row])
            fresh = (np.repeat(query, n[row]), child_low[child], child_high[child], code[child])
            inside = length[fresh[0]] > depth
            other = ~inside
            other[inside] = at(fresh[0][inside], depth) != fresh[3][inside]
            fresh = tuple(x[other] for x in fresh)
        into = length[fresh[0]] > depth
        replaced = tuple(np.concatenate(x) for x in zip(grown(*replaced, depth), [x[into] for x in fresh[:3]], strict=True))
        inserted = tuple(np.concatenate(x) for x in zip(grown(*inserted, depth - 1) if depth else inserted, fresh[:3], strict=True))
        dropped = grown(*dropped, depth + 1)
        on = length[exact] > depth
        exact, low, high = exact[on], low[on], high[on]
        code = at(exact, depth)
        low, high = index.step(code, low), index.step(code, high)
        on = high > low
        exact, low, high = exact[on], low[on], high[on]
        if not any(len(x) for x in (exact, replaced[0], inserted[0], dropped[0])):
            break
    return tuple(np.concatenate([none, *x]) for x in zip(*found, strict=True)) if found else (none, none)


class Strings:
    """Words as character codes: codes, with start and length of each word."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet, self.codes = np.unique(points, return_inverse=True)
        self.codes = self.codes.astype(np.int64) + 1
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length


def neighbours(words: list[str], n: np.ndarray, sought: np.ndarray, listed: np.ndarray, backward: bool) -> Iterator[pa.RecordBatch]:
    """For each sought word that has near words among the listed ones: their number, the one of largest n and that n.  words: different, in order."""
    strings = Strings([w[::-1] for w in words] if backward else words)
    index = Index(strings.codes, strings.start[listed], strings.length[listed])
    for at in range(0, len(sought), SOUGHT):
        own = sought[at : at + SOUGHT]
        length = strings.length[own]
        query, word = pairs_within(index, strings.codes, strings.start[own], length, length // 2)
        query, word = own[query], listed[word]
        if backward:  # those with equal left halves were found from there
            half, same = strings.length[query] // 2, np.ones(len(query), bool)
            ends = strings.start + strings.length - 1
            for k in range(int(half.max(initial=0))):
                live = np.flatnonzero(same & (half > k))
                live = live[strings.length[word[live]] > k]
                same[live] = strings.codes[ends[query[live]] - k] == strings.codes[ends[word[live]] - k]
            query, word = query[~same], word[~same]
        if not len(query):
            continue
        order = np.lexsort((word, -n[word], query))
        query, word = query[order], word[order]
        lead = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        best = word[lead]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in query[lead]], pa.string()),
                pa.array(np.diff([*lead, len(query)]), pa.int64()),
                pa.array([words[i] for i in best], pa.string()),
                pa.array(n[best], pa.int64()),
            ],
            names=["word", "n_near", "near", "near_n"],
        )


# --- the search over all words ---------------------------------------------------------------------------------------


def by_half(words: DataFrame, block: int) -> DataFrame:
    """Each word under its halves: backward, half (exact characters), share (block of a hot half), asks (is sought there), word, n."""
    length = F.length("word")
    each = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"))
    each = each.withColumn("size", F.explode(F.array_distinct(F.array(*[F.floor((length + d) / 2).cast("int") for d in (-1, 0, 1)]))))
    spelled = F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word"))
    each = each.filter(F.col("size") <= length).select("word", "n", "backward", F.concat_ws(":", "size", F.substring(spelled, F.lit(1), F.col("size"))).alias("half"), (F.col("size") == F.floor(length / 2)).alias("asks"))
    hot = each.groupBy("backward", "half").agg(F.count("*").alias("members")).filter(F.col("members") > block)
    each = each.join(hot.select("backward", "half", F.ceil(F.col("members") / block).cast("int").alias("blocks")), ["backward", "half"], "left")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    share = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    return each.withColumn("share", F.explode(share)).withColumn("listed", (F.col("share") < 0) | (F.col("share") == own)).drop("blocks")


def near_words(words: DataFrame, block: int = 50_000, buckets: int | None = None) -> DataFrame:
    """word, n_near, near (the near word of largest n, then the smallest), near_n: for every word that has near words."""
    buckets = buckets or 2 * shuffle_partitions(words.sparkSession)
    spread = by_half(words, block)
    hot = F.col("share") >= 0
    # a block of a hot half is searched by itself; the other halves of a task share one index
    group = F.when(hot, F.concat_ws(":", F.col("backward").cast("int"), "share", "half")).otherwise(F.when(F.col("backward"), "b").otherwise("f"))
    bucket = F.pmod(F.xxhash64("backward", "half", "share"), F.lit(buckets)).cast("int")
    rows = spread.select(bucket.alias("bucket"), group.alias("grp"), "backward", "asks", "listed", "word", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            grp = batch.column("grp").dictionary_encode()
            cut = np.flatnonzero(np.diff(grp.indices.to_numpy())) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if held and part.num_rows and held[-1].column("grp")[0].as_py() != part.column("grp")[0].as_py():
                    yield from searched(held)
                    held = []
                if part.num_rows:
                    held.append(part)
        if held:
            yield from searched(held)

    def searched(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a word comes once for each of its halves here; it is listed once and sought if any of them says so
        table = pa.Table.from_batches(parts).group_by(["word"]).aggregate([("n", "max"), ("asks", "max"), ("listed", "max")]).sort_by("word")
        words_, listed = table.column("word").to_pylist(), table.column("listed_max").to_numpy()
        n, asks = table.column("n_max").to_numpy(), table.column("asks_max").to_numpy()
        backward = parts[0].column("backward")[0].as_py()
        yield from neighbours(words_, n, np.flatnonzero(asks), np.flatnonzero(listed), backward)

    dealt = rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("grp").drop("bucket")
    found = dealt.mapInArrow(run, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.w").alias("near"), (-F.col("b.k")).alias("near_n"))


def variant_groups(words: DataFrame, ratio: int = 10, block: int = 50_000, buckets: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.  words: word, n.

    form: the near word of largest n if that is at least ``ratio`` times the word's own; root: the last form that forms lead to.
    """
    found = near_words(words, block, buckets).withColumnRenamed("word", "__word")
    joined = words.join(found, F.col("word") == F.col("__word"), "left")
    form = F.col("near_n") >= ratio * F.col("n")
    rows = stored(joined.select("word", F.when(form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("near_n")).alias("form_n")), "forms")
    # n grows from form to form by the ratio, so few rounds of doubling reach every end
    leads, moved = rows.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), True
    while moved:
        onward = leads.select(F.col("word").alias("__at"), F.col("root").alias("__to"))
        leads = leads.join(onward, F.col("root") == F.col("__at"), "left")
        leads = stored(leads.select("word", F.coalesce("__to", "root").alias("root"), F.col("__to").isNotNull().alias("moved")), "roots")
        moved = not leads.filter("moved").isEmpty()
    ends = leads.select(F.col("word").alias("__word"), "root")
    out = rows.join(ends, F.col("word") == F.col("__word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, slip: int | None = None, block: int = 50_000, buckets: int | None = None) -> DataFrame:
    """The variants among the words of all texts; see count_words and variant_groups."""
    words = stored(count_words(documents, min_length, min_count, slip), "words")
    return variant_groups(words, ratio, block, buckets)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"), slip=31)


#: CRC-32 by its table of 256 remainders (reflected polynomial 0xEDB88320), byte by byte.
CRC_SQL = r"""
crc_bits as (select list_reduce(list_prepend(b::bigint, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as t, b from range(256) as r(b)),
crc_table as (select list(t order by b) as ts from crc_bits)
"""
#: With x: a row's bytes as numbers; ts: the table.
CRC_OF = "xor(list_reduce(list_prepend(4294967295::bigint, x), lambda c, v: xor(c >> 8, ts[1 + (xor(c, v) & 255)])), 4294967295)"

OP11_SQL = (
    "with "
    + CRC_SQL
    + r""",
runs as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]{7,}')) as run from documents),
each as (select doc_id, run, count(*) as k, coalesce(doc_id::varchar, '') || ':' || run as s from runs group by doc_id, run),
bytes as (select run, k, list_transform(range(1, octet_length(encode(s))::bigint * 2, 2), lambda i: ('0x' || hex(encode(s))[i : i + 1])::bigint) as x from each),
hashed as (select run, k, """
    + CRC_OF
    + r""" as h from bytes, crc_table),
slipped as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, k from hashed),
v as (select word, sum(k)::bigint as n from slipped where length(word) >= 7 group by word having sum(k) >= 2),
cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
near as (
  select distinct c.word as a, v.word as b from cut c join v on c.rest = v.word
  union select distinct v.word, c.word from cut c join v on c.rest = v.word
  union select distinct c.word, d.word from cut c join cut d on c.rest = d.rest and c.i = d.i and c.word <> d.word),
best as (select a, count(*)::bigint as n_near, max(v.n) as top, min(struct_pack(k := -v.n, w := v.word)).w as w from near join v on v.word = b group by a),
f as (select v.word, case when top >= 10 * v.n then w end as form, v.n, coalesce(n_near, 0)::bigint as n_near, case when top >= 10 * v.n then top end::bigint as form_n from v left join best on a = v.word),
r as (with recursive walk as (select word, word as root, form as nxt from f union all select walk.word, f.word, f.form from walk join f on f.word = walk.nxt) select word, root from walk where nxt is null)
select f.word, form, root, n, n_near, form_n from f join r using (word)
"""
)
