"""Quality rules as a short-circuit cascade.

Every rule rejects a document for one reason.  On a sample of documents (about SAMPLE_ROWS, chosen by a hash of doc_id) each
rule is run over all rows: its seconds are its cost, its share of rejections its selectivity.  The rules are then ordered
by rejections per second, and over the whole table a rule only sees the documents that all earlier rules let pass.  The
order changes the work, never the verdict: a document is kept if no rule rejects it.

Metrics (contract of the base): n_words, word_chars (code points in words), n_symbols (characters of ``[#*$%&|<>]``),
n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in five-word windows that are found twice or more
in the text, the first included).  With ``metrics`` they are computed for all documents; without, only as far as the cascade goes.

Edge cases: null and empty texts have no words and fail the base rule; texts shorter than five words have no windows; rows without doc_id
and repeated rows are judged like any other, each by itself; a very long text makes a step of its own; rules that tie in rejections per second
keep their given order; an empty table gives an empty result; other columns are kept by ``keep_good``, whatever their names.  Lines and
windows are equal if two independent 64-bit hashes are (multilinear, see common.hash_slices), so none collide by their form.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, hash_slices, mix, read_table, text_bytes, text_steps, words_of

SAMPLE_ROWS = 2000
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True
_BEGINS = np.ones(256, bool)  # bytes that begin a code point
_BEGINS[0x80:0xC0] = False


@dataclass
class Texts:
    """Some documents; what rules need is computed once and kept."""

    data: np.ndarray
    offs: np.ndarray
    known: dict[str, np.ndarray | Words] = field(default_factory=dict)

    def words(self) -> Words:
        if "words" not in self.known:
            self.known["words"] = words_of(self.data, self.offs)
        return self.known["words"]

    def get(self, name: str) -> np.ndarray:
        if name not in self.known:
            self.known[name] = METRICS[name](self)
        return self.known[name]

    def only(self, rows: np.ndarray) -> Texts:
        """These documents alone; metrics that are known come along."""
        length = np.diff(self.offs)
        keep = np.zeros(len(length), bool)
        keep[rows] = True
        known = {k: v[rows] for k, v in self.known.items() if k != "words"}
        return Texts(self.data[np.repeat(keep, length)], np.concatenate([[0], np.cumsum(length[rows])]), known)


def per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def n_words(t: Texts) -> np.ndarray:
    return np.diff(t.words().first).astype(np.int64)


def word_chars(t: Texts) -> np.ndarray:
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    return per_text((_BEGINS & ~blank)[t.data], t.offs)


def n_symbols(t: Texts) -> np.ndarray:
    return per_text(_SYMBOL[t.data], t.offs)


def n_capitals(t: Texts) -> np.ndarray:
    """Words with two capital letters or more and no small one, of ASCII."""
    w = t.words()
    if not len(w):
        return np.zeros(len(t.offs) - 1, np.int64)
    ends = np.concatenate([w.start, [len(w.data)]])
    return per_text((per_text(_UPPER[w.data], ends) >= 2) & (per_text(_LOWER[w.data], ends) == 0), w.first)


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """For each line with a word: its document, and whether it equals an earlier one of it."""
    n = len(t.offs) - 1
    data = t.data
    # line breaks, and the ends of the documents as one more break each
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([t.offs[:-1], breaks + 1]))
    owner = np.searchsorted(t.offs[:-1], begin, side="right") - 1
    # a break as a document's last byte makes an empty line, which begins where the next document does: it has no word
    end = np.minimum(np.concatenate([begin[1:], [len(data)]]), t.offs[owner + 1]) if n else begin
    w = t.words()
    starts = word_starts(t)
    filled = np.searchsorted(starts, end) > np.searchsorted(starts, begin) if len(w) else np.zeros(len(begin), bool)
    begin, end, owner = begin[filled], end[filled], owner[filled]
    if not len(begin):
        return owner, np.zeros(0, bool)
    # without its break, so that the last line of a text equals the same line further up
    cut = end - ((data[end - 1] == 0x0A) & (end > begin)).astype(np.int64)
    kept = np.zeros(len(data) + 1, np.int32)
    np.add.at(kept, begin, 1)
    np.add.at(kept, cut, -1)
    packed = data[np.cumsum(kept[:-1]) > 0]
    size = cut - begin
    at = np.cumsum(size) - size
    a, b = hash_slices(packed, at, size, BASE_A), hash_slices(packed, at, size, BASE_B)
    return owner, earlier(a ^ mix(owner.astype(U64)), b)


def word_starts(t: Texts) -> np.ndarray:
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    inside = ~blank[t.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[t.offs[:-1][t.offs[:-1] < len(inside)]] |= inside[t.offs[:-1][t.offs[:-1] < len(inside)]]
    return np.flatnonzero(begins)


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order in which equal (a, b) stand together, by place within; flags for the first of each."""
    order = np.lexsort((b, a)) if len(a) < 1 << 12 else np.argsort(a, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = a[order][1:] != a[order][:-1]
    if ((b[order][1:] != b[order][:-1]) & ~new[1:]).any():  # one 64-bit hash for two contents
        order = np.lexsort((b, a))
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return order, new


def earlier(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order, new = groups(a, b)
    out = np.empty(len(a), bool)
    out[order] = ~new
    return out


def n_lines(t: Texts) -> np.ndarray:
    owner, copy = lines(t)
    t.known["n_dup_lines"] = np.bincount(owner[copy], minlength=len(t.offs) - 1)
    return np.bincount(owner, minlength=len(t.offs) - 1)


def n_dup_lines(t: Texts) -> np.ndarray:
    t.get("n_lines")
    return t.known["n_dup_lines"]


def n_repeat_words(t: Texts) -> np.ndarray:
    w = t.words()
    n = len(w) - WINDOW + 1
    out = np.zeros(len(t.offs) - 1, np.int64)
    if n <= 0:
        return out
    doc = w.doc()
    inside = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    a, b = w.hashes(BASE_A), w.hashes(BASE_B)
    x, y = np.zeros(n, U64), np.zeros(n, U64)
    for k in range(WINDOW):
        x, y = x * U64(BASE_B) + a[k : k + n], y * U64(BASE_A) + b[k : k + n]
    x = mix(x[inside]) ^ mix(doc[inside].astype(U64))
    order = np.argsort(x)
    sx, sy = x[order], y[inside][order]
    new = np.ones(len(order), bool)
    new[1:] = sx[1:] != sx[:-1]
    if ((sy[1:] != sy[:-1]) & ~new[1:]).any():
        order, new = groups(x, y[inside])
    often = ~new
    often[:-1] |= ~new[1:]
    depth = np.zeros(len(w) + 1, np.int32)
    at = inside[order[often]]
    np.add.at(depth, at, 1)
    np.add.at(depth, at + WINDOW, -1)
    return per_text(np.cumsum(depth[:-1]) > 0, w.first)


METRICS: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_capitals": n_capitals, "n_lines": n_lines, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
}

#: name: flags of the documents that the rule rejects.
RULES: dict[str, Callable[[Texts], np.ndarray]] = {
    "few_words": lambda t: t.get("n_words") < 10,
    "repeated_windows": lambda t: 100 * t.get("n_repeat_words") > 20 * t.get("n_words"),
    "symbols": lambda t: 10 * t.get("n_symbols") > t.get("n_words"),
    "capitals": lambda t: 2 * t.get("n_capitals") > t.get("n_words"),
    "duplicate_lines": lambda t: 10 * t.get("n_dup_lines") > 4 * t.get("n_lines"),
    "word_length": lambda t: (t.get("word_chars") > 15 * t.get("n_words")) | (t.get("word_chars") < 2 * t.get("n_words")),
}
BASE = ("few_words", "repeated_windows")


def rule_order(documents: DataFrame, rules: tuple[str, ...], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on a sample, the best first."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {r: [0.0, 0] for r in rules}
        for batch in batches:
            for step in text_steps(batch):
                for name in rules:
                    began = time.thread_time()
                    rejected = int(RULES[name](Texts(*text_bytes(step.column("text")))).sum())
                    found[name][0] += time.thread_time() - began
                    found[name][1] += rejected
        yield pa.RecordBatch.from_arrays([pa.array(list(rules)), pa.array([x[0] for x in found.values()]), pa.array([x[1] for x in found.values()], pa.int64())], names=["rule", "cost", "rejected"])

    rows = max(1, documents.count() // sample_rows)
    sample = documents.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(rows)) == 0).select("text")
    stats = sample.mapInArrow(measure, "rule string, cost double, rejected long").groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected")).collect()
    worth = {r.rule: (r.rejected + 0.5) / (r.cost + 1e-6) for r in stats}
    return sorted(rules, key=lambda r: -worth.get(r, 0))


def cascade(texts: Texts, order: list[str]) -> np.ndarray:
    """For each document the number of the rule that rejects it, -1 for none; later rules see what is left."""
    verdict = np.full(len(texts.offs) - 1, -1)
    rows = np.arange(len(verdict))
    for k, name in enumerate(order):
        if not len(rows):
            break
        bad = RULES[name](texts)
        verdict[rows[bad]] = k
        if bad.any():
            rows = rows[~bad]
            texts = texts.only(np.flatnonzero(~bad))
    return verdict


def quality_report(documents: DataFrame, rules: tuple[str, ...] = tuple(RULES), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the metrics, base_failed and kept of every row."""
    order = rule_order(documents, rules, sample_rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch):
                texts = Texts(*text_bytes(step.column("text")))
                values = [texts.get(n) for n in names]
                base = np.any([RULES[r](texts) for r in BASE], axis=0)
                kept = (cascade(texts, order) < 0) & ~base
                yield pa.RecordBatch.from_arrays([step.column("doc_id"), *(pa.array(v.astype(np.int64)) for v in values), pa.array(base), pa.array(kept)], names=["doc_id", *names, "base_failed", "kept"])

    return documents.select("doc_id", "text").mapInArrow(judge, "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean")


def keep_good(documents: DataFrame, rules: tuple[str, ...] = tuple(RULES), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, all columns as they are."""
    order = rule_order(documents, rules, sample_rows)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch):
                good = cascade(Texts(*text_bytes(step.column("text"))), order) < 0
                yield step.filter(pa.array(good))

    return documents.mapInArrow(select, documents.schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l from d),
g as (select r, unnest(range(1, len(w) - 3)) as i, w from w where len(w) >= 5),
h as (select r, i, count(*) over (partition by r, w[i : i + 4]) as n from g),
c as (select r, count(distinct k) as n from (select r, unnest(range(i, i + 5)) as k from h where n > 1) group by r),
m as (select w.doc_id, len(w)::bigint as n_words, len(array_to_string(w, ''))::bigint as word_chars,
 len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
 len(l) as n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') and not regexp_matches(x, '[a-z]'))) as n_capitals from w left join c using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not (base_failed or 10 * n_symbols > n_words or 2 * n_capitals > n_words or 10 * n_dup_lines > 4 * n_lines or word_chars > 15 * n_words or word_chars < 2 * n_words) as kept from b
"""
