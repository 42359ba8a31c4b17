"""Line dedup by an exact set-similarity join.  DataFrame operations only.

A line with at least ``min_words`` words (by default one: only blank lines are left out) is the set of its words.  It is removed if an earlier
line (smaller doc_id, or further up in the same document) has a set with Jaccard similarity of at least ``percent`` / 100; lines are judged
on the input.

1. Rarity: words are counted over the whole corpus in 65,536 hash slots; a word's key is the rank of its slot (rarest first)
   followed by the rest of its 64-bit hash, so sorting the keys orders a line's words by rarity.
2. Equal sets become one, with their first place, in one aggregate over 128 bits of the sorted keys; a line repeated a million times is one
   row after it.
3. Prefix filter: two similar sets share one of the larger one's first n - ceil(t * n) + 1 and of the smaller one's first
   m - ceil(2 * t / (1 + t) * m) + 1 keys.  The sets meet by those keys within their size class; those that may be similar to sets of the next
   class also meet these.  Sets so small that only an equal one is similar don't take part.  Length filter: sizes within the threshold.
   Positional filter: what follows the common key must be enough.  A parity bitmap of 64 or 128 bits bounds the difference of two sets from
   below and drops most of the rest.
4. A set needs only one earlier witness.  Where more than FEW sets meet by a key, a set is held against the earliest one there, if the
   filters allow that one, else against all earlier ones that they allow; a set whose earliest ones were refuted is then held against all.  So a
   group of thousands of variants costs one pair each, and no link is lost.
5. Verification: Jaccard on the words of the pairs' lines, read from the texts again.

Edge cases: null text has no lines; blank lines (and those with fewer than ``min_words`` words) stay; a text in one very long line is one set; of
equal lines in one document the first stays; rows without doc_id are returned untouched and remove nothing; rows that
repeat a doc_id with one text keep and lose the same line numbers, with another text a line number stays if it stays in one of them; an empty
table gives an empty result; ``keep_first_lines`` keeps all other columns, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, read_table, stored

c = F.col

#: What parts words.
BLANKS = " \t\n\x0b\x0c\r"
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
#: Sets that meet by a key are all held against each other up to so many, else against the earliest first.
FEW = 64
#: Sets meet only those of their size class, or of the next smaller one; so many times larger are the sizes of the next class.
CLASS = 3
#: Bits of the filter that keeps what can't join from being shuffled; its size is fixed.
FILTER_BITS = 20
#: Words from which a line's parity takes 128 bits.
LONG = 60


def enough(line: Column, min_words: int) -> Column:
    return F.ltrim(line, F.lit(BLANKS)) != "" if min_words <= 1 else F.regexp_count(line, F.lit(WORD)) >= min_words


def plain(text: Column) -> Column:
    """The text with blanks and line ends only between its words: split() finds single characters fastest."""
    others = [b for b in BLANKS if b not in " \n"]
    return F.when(reduce(Column.__or__, [F.contains(text, F.lit(b)) for b in others]), F.translate(text, "".join(others), " " * len(others))).otherwise(text)


def text_lines(documents: DataFrame, min_words: int) -> DataFrame:
    """doc_id, line_no, line of every line that has enough words."""
    lines = documents.select("doc_id", F.posexplode(F.split(plain(c("text")), "\n")).alias("line_no", "line"))
    return lines.filter(F.trim("line") != "" if min_words <= 1 else enough(c("line"), min_words))


def words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def slot_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - SLOT_BITS)


def slot_ranks(documents: DataFrame) -> Column:
    """An array of SLOTS longs; ``h ^ ranks[slot of h]`` has the rank of the slot, by its words' count in the corpus, for the slot.  Its size is fixed."""
    text = F.replace(plain(c("text")), F.lit("\n"), F.lit(" "))
    word = documents.select(F.explode(F.split(text, " ")).alias("word"))  # with the empty ones between blanks: they only make their slot more frequent
    counts = word.groupBy(slot_of(F.xxhash64("word")).alias("slot")).agg(F.count("*").alias("n")).collect()
    n = {r.slot: r.n for r in counts}
    ranks = [0] * SLOTS
    for i, slot in enumerate(sorted(range(SLOTS), key=lambda s: (n.get(s, 0), s))):
        change = slot ^ (i - SLOTS // 2) % SLOTS  # the rarest slot gets the smallest signed number
        ranks[slot] = (change - SLOTS * (change >= SLOTS // 2)) << (64 - SLOT_BITS)
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<long>")


def one_of(column: Column, keys: DataFrame) -> Column:
    """False only where the value isn't among the keys (of one column): a bitmap of FILTER_BITS bits, whatever the number of keys, drops rows before a shuffle."""

    def place(k: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(k), 64 - FILTER_BITS).cast("int")

    (name,) = keys.columns
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place(c(name)).bitwiseAND(63))
    found = keys.groupBy(F.shiftright(place(c(name)), 6).alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    bits = [0] * (1 << (FILTER_BITS - 6))
    for r in found:
        bits[r["at"]] = r["bits"]
    held = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<long>")
    return F.call_function("shiftrightunsigned", F.get(held, F.shiftright(place(column), 6)), place(column).bitwiseAND(63)).bitwiseAND(1) == 1


def prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100).cast("int") + 1


def mid_length(n: Column, percent: int) -> Column:
    """So many first keys of a set hold one in common with any similar set that is no smaller."""
    return n - F.ceil(n * (2 * percent) / (100 + percent)).cast("int") + 1


def size_class(n: Column, percent: int) -> Column:
    """Two similar sets are in one class, or the larger one is in the next."""
    return F.floor(F.log(n.cast("double")) / math.log(max(CLASS, 101 / percent))).cast("int")


def distinct_sets(documents: DataFrame, percent: int, min_words: int) -> DataFrame:
    """doc_id and line_no of the first line of each set of words, n, bits, more (parity bits), prefix."""
    ranks, lines = slot_ranks(documents), text_lines(documents, min_words)

    def key(h: Column) -> Column:
        return h.bitwiseXOR(F.get(ranks, slot_of(h)))

    hashes = F.array_distinct(F.transform(F.split("line", " "), lambda w: F.xxhash64(w)))
    hashes = F.array_remove(hashes, F.xxhash64(F.lit("")))  # what stands between two blanks
    keyed = lines.select("doc_id", "line_no", F.sort_array(F.transform(hashes, key)).alias("keys"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def parity(keys: Column) -> Column:
        """64 parity bits of the keys."""
        return F.aggregate(keys, zero, lambda a, k: a.bitwiseXOR(F.call_function("shiftleft", one, k.bitwiseAND(63).cast("int"))))

    n = F.size("keys")
    # short lines need 64 bits only; of a long line the keys with one bit more have their own
    half = F.when(n > LONG, parity(F.filter("keys", lambda k: k.bitwiseAND(64) != 0))).otherwise(0)
    alone = n * 100 < (n + 1) * percent  # even one word more makes a set that isn't similar
    prefix = F.slice("keys", 1, F.when(alone, 0).otherwise(prefix_length(n, percent)))
    keyed = keyed.select("*", half.alias("more"), parity(c("keys")).alias("all"))
    digest = [F.xxhash64("keys").alias("sid"), F.xxhash64(F.lit(SLOT_BITS), "keys").alias("check")]
    made = keyed.select(*digest, n.alias("n"), F.struct("doc_id", "line_no").alias("place"), c("all").bitwiseXOR(c("more")).alias("bits"), "more", prefix.alias("prefix"))
    first = made.groupBy("sid", "check", "n").agg(F.min("place").alias("place"), F.first("bits").alias("bits"), F.first("more").alias("more"), F.first("prefix").alias("prefix"))
    return first.select("place.doc_id", "place.line_no", "n", "bits", "more", "prefix")


def field(row: str | Column, name: str) -> Column:
    """A column of an aliased row (``alias.``), or a field of a struct."""
    return c(f"{row}{name}") if isinstance(row, str) else row[name]


def may_match(x: str | Column, y: str, percent: int) -> Column:
    """Length, positional and bitmap filters for two rows (n words, a common key at place i from 0): can percent / (100 + percent) of n + m be common?"""
    n, i, m, j = field(x, "n"), field(x, "i"), c(f"{y}n"), c(f"{y}i")
    need = (n + m) * percent
    # before the common key at most min(i, j) keys are common, from it on at most the shorter rest
    room = F.least(i, j) + F.least(n - i, m - j)
    low, high = field(x, "bits").bitwiseXOR(c(f"{y}bits")), field(x, "more").bitwiseXOR(c(f"{y}more"))
    differ = F.when((n > LONG) & (m > LONG), F.bit_count(low) + F.bit_count(high)).otherwise(F.bit_count(low.bitwiseXOR(high)))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (room * (100 + percent) >= need) & (F.shiftright(n + m - differ, 1) * (100 + percent) >= need)


def met(sets: DataFrame, percent: int) -> DataFrame:
    """A row for each key by which a set meets others of its size class, and for those by which it meets larger ones of the next class: doc_id,
    line_no, bits, more, key (of both), packed (see ``unpacked``)."""
    n, length = c("n").cast("long"), F.size("prefix")
    own = size_class(n, percent)
    next_too = size_class(F.floor(n * 100 / percent), percent) > own
    keys = F.concat("prefix", F.slice("prefix", 1, F.when(next_too, F.least(mid_length(n, percent), length)).otherwise(0)))
    rows = sets.filter(length > 0).select("doc_id", "line_no", "bits", "more", n.alias("n"), own.cast("long").alias("class"), length.alias("length"), F.posexplode(keys).alias("at", "word"))
    home = c("at") < c("length")
    low = F.when(home, c("at") * 2 + 1).otherwise((c("at") - c("length")) * 2)
    key = c("word").bitwiseXOR(c("class") + F.when(home, 0).otherwise(1))
    rows = rows.select("doc_id", "line_no", "bits", "more", key.alias("key"), F.shiftleft("n", 32).bitwiseOR(low.cast("long")).alias("packed"))
    # nothing here is null, but said on both sides alike it lets both sides of the join read one exchange
    return rows.filter(" and ".join(f"{name} is not null" for name in rows.columns))


def unpacked(packed: Column, percent: int) -> list[Column]:
    """n, i: the key's place in the set, home: in the own class, small: similar sets that are no smaller are found by this row."""
    n, i = F.shiftright(packed, 32), F.shiftright(packed.bitwiseAND((1 << 32) - 1), 1)
    return [n.alias("n"), i.alias("i"), (packed.bitwiseAND(1) == 1).alias("home"), (i < mid_length(n, percent)).alias("small")]


def before(x: str | Column, y: str) -> Column:
    """Whether the first place comes before the second one."""
    doc, line = field(x, "doc_id"), field(x, "line_no")
    return (doc < c(f"{y}doc_id")) | ((doc == c(f"{y}doc_id")) & (line < c(f"{y}line_no")))


def here(condition: Column) -> Column:
    """The condition, where Spark can't move it below an exchange or into a join."""
    return F.when(F.monotonically_increasing_id() >= 0, condition)


def candidate_pairs(sets: DataFrame, percent: int, only: DataFrame | None = None) -> DataFrame:
    """Later and earlier sets (u_doc, u_line, v_doc, v_line) that may be similar.  led_by: the key by which u was held against its earliest set v
    alone; null where it was held against all.  only: doc_id, line_no, keys of sets that need all by these keys.
    """
    rows = met(sets, percent)
    names = ["u_doc", "u_line", "v_doc", "v_line", "led_by"]
    fields = ["doc_id", "line_no", "bits", "more", "key", *unpacked(c("packed"), percent)]
    if only is not None:
        own = sets.filter(one_of(c("doc_id"), only.select("doc_id"))).join(only.select("doc_id", "line_no").hint("merge"), ["doc_id", "line_no"])
        wanted = only.select("doc_id", "line_no", F.explode("keys").alias("key"))
        x = met(own, percent).join(wanted.hint("merge"), ["doc_id", "line_no", "key"]).select(fields).alias("x")
        y = rows.filter(one_of(c("key"), wanted.select("key"))).select(fields).hint("merge").alias("y")
        pairs = x.join(y, (c("x.key") == c("y.key")) & may_match("x.", "y.", percent) & before("y.", "x."))
        return pairs.select("x.doc_id", "x.line_no", "y.doc_id", "y.line_no", F.lit(None).cast("long")).toDF(*names).distinct()
    # by the key alone: the rows of a key need no order, the earliest one is the least
    all_, dealt = Window.partitionBy("key"), rows.repartition("key")
    x = dealt.select("*", F.count("*").over(all_).alias("company"), F.min(F.struct("doc_id", "line_no", "packed", "bits", "more")).over(all_).alias("least")).filter("company > 1")
    lead = F.struct("least.doc_id", "least.line_no", "least.bits", "least.more", *unpacked(c("least.packed"), percent))
    x = x.select(*fields, F.when(c("company") > FEW, lead).alias("lead")).filter("home").alias("x")
    y = dealt.select(fields).filter(here(c("small"))).alias("y")  # after the exchange, which both sides read
    later = before("y.", "x.")
    # of a larger and a smaller set, or of two of one size the later and the earlier one
    sizes = (c("y.n") < c("x.n")) | ((c("y.n") == c("x.n")) & later)

    def led(lead: Column, name: str) -> Column:
        """Whether the set is held against the earliest one by this key."""
        roles = F.when(lead["n"] <= c(f"{name}n"), lead["small"] & c(f"{name}home")).otherwise(lead["home"] & c(f"{name}small"))
        return before(lead, name) & roles & may_match(lead, name, percent)

    def is_lead(lead: Column, name: str) -> Column:
        return (c(f"{name}doc_id") == lead["doc_id"]) & (c(f"{name}line_no") == lead["line_no"])

    def to_lead(lead: Column) -> Column:
        return F.when(later, is_lead(lead, "y.")).otherwise(is_lead(lead, "x."))

    # few pairs come so far; within the join's loop this would make more code than is compiled, as a lambda it is kept apart
    allowed = F.exists(F.array("x.lead"), lambda lead: lead.isNull() | to_lead(lead) | ~F.when(later, led(lead, "x.")).otherwise(led(lead, "y.")))
    pairs = x.join(y, (c("x.key") == c("y.key")) & sizes & may_match("x.", "y.", percent)).filter(here(allowed))
    place = lambda name: F.struct(c(f"{name}doc_id").alias("doc"), c(f"{name}line_no").alias("line"))
    u, v = F.when(later, place("x.")).otherwise(place("y.")), F.when(later, place("y.")).otherwise(place("x."))
    return pairs.select(u.alias("u"), v.alias("v"), F.when(to_lead(c("x.lead")), c("x.key")).alias("led_by")).select("u.doc", "u.line", "v.doc", "v.line", "led_by").toDF(*names).distinct()


def confirmed(pairs: DataFrame, documents: DataFrame, percent: int, min_words: int) -> DataFrame:
    """Later sets (doc_id, line_no) of the pairs whose full sets of words are similar."""
    places = pairs.select(F.explode(F.array(F.struct(c("u_doc").alias("doc_id"), c("u_line").alias("line_no")), F.struct(c("v_doc").alias("doc_id"), c("v_line").alias("line_no")))).alias("p")).select("p.*")
    wanted = places.groupBy("doc_id").agg(F.collect_set("line_no").alias("wanted"))
    # how many documents these are grows with the table, so they are never sent to all
    wanted = stored(wanted, "line-wanted")
    texts = documents.select("doc_id", "text").filter(one_of(c("doc_id"), wanted.select("doc_id"))).join(wanted.hint("merge"), "doc_id")
    lines = text_lines(texts.select(F.struct("doc_id", "wanted").alias("doc_id"), "text"), min_words).filter(F.array_contains("doc_id.wanted", c("line_no")))
    sets = lines.select("doc_id.doc_id", "line_no", F.array_distinct(words(c("line"))).alias("w"))
    sets = stored(sets.groupBy("doc_id", "line_no").agg(F.max("w").alias("w")), "line-sets")  # rows that repeat
    joined = pairs.join(sets.selectExpr("doc_id as u_doc", "line_no as u_line", "w as wu"), ["u_doc", "u_line"]).join(sets.selectExpr("doc_id as v_doc", "line_no as v_line", "w as wv"), ["v_doc", "v_line"])
    similar = joined.filter(F.size(F.array_intersect("wu", "wv")) * (100 + percent) >= (F.size("wu") + F.size("wv")) * percent)
    return similar.select(F.col("u_doc").alias("doc_id"), F.col("u_line").alias("line_no")).distinct()


def first_lines(documents: DataFrame, percent: int, min_words: int) -> DataFrame:
    """doc_id and kept, the numbers of its lines that no earlier line is similar to; documents with none are left out."""
    documents = documents.filter("doc_id is not null")
    # keys hardly repeat, so a dictionary of them would be built for nothing
    sets = stored(distinct_sets(documents, percent, min_words), "line-prefixes", {"parquet.enable.dictionary": "false"})
    pairs = stored(candidate_pairs(sets, percent), "line-pairs")
    names = ["u_doc", "u_line", "v_doc", "v_line"]
    led = pairs.filter("led_by is not null")
    tried = pairs.filter("led_by is null").select(names).unionByName(led.select(names).distinct())
    removed = stored(confirmed(tried, documents, percent, min_words), "line-removed")
    place = ["doc_id", "line_no"]
    # sets that their earliest ones don't remove are held against all, by the keys by which they were held against those alone
    again = stored(led.groupBy(c("u_doc").alias("doc_id"), c("u_line").alias("line_no")).agg(F.collect_set("led_by").alias("keys")).join(removed, place, "left_anti"), "line-again")
    if again.limit(1).count():
        more = stored(candidate_pairs(sets, percent, again).select(names).join(tried, names, "left_anti"), "line-pairs")
        removed = removed.unionByName(confirmed(more, documents, percent, min_words))
    kept = sets.select(place).join(removed, place, "left_anti")
    return kept.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("kept"))


def line_report(documents: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """doc_id, n_lines (with a word), n_long (with min_words words), n_removed, kept_long (numbers of the long lines that stay, comma-joined) of every row."""
    kept = first_lines(documents, percent, min_words).select(F.col("doc_id").alias("_id"), "kept")
    none = F.array().cast("array<int>")

    def numbers(least: int) -> Column:
        """Numbers of the lines with so many words."""
        found = F.filter(F.transform("l", lambda line, i: F.when(enough(line, least), i)), lambda i: i.isNotNull())
        return F.coalesce(found, none)

    rows = documents.select("doc_id", F.split("text", "\n").alias("l"))
    rows = rows.select("doc_id", numbers(min_words).alias("long"), *([] if min_words <= 1 else [F.size(numbers(1)).alias("lines")]))
    lines = F.size("long") if min_words <= 1 else c("lines")
    joined = rows.join(kept, F.col("doc_id") == F.col("_id"), "left")
    stays = F.when(F.col("doc_id").isNull(), F.col("long")).otherwise(F.coalesce(F.array_intersect("long", "kept"), none))
    return joined.select("doc_id", lines.cast("long").alias("n_lines"), F.size("long").cast("long").alias("n_long"), (F.size("long") - F.size(stays)).cast("long").alias("n_removed"), F.array_join(stays, ",").alias("kept_long"))


def several_texts(documents: DataFrame) -> bool:
    """Whether rows with different texts share a doc_id."""
    key = F.xxhash64("text")
    ids = documents.filter("doc_id is not null").groupBy("doc_id").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    return not ids.filter("a != b").isEmpty()


def keep_first_lines(documents: DataFrame, percent: int = 80, min_words: int = 1) -> DataFrame:
    """documents without the lines that are similar to an earlier one; a document of which no word is left goes.  Texts without words stay as they are.

    Rows that share a doc_id with another text are told apart by their texts; the order of two of them is that of the texts' hashes.
    """
    named = lambda doc, text: F.struct(doc.alias("doc"), F.xxhash64(text).alias("text"))
    apart = several_texts(documents)
    given_ids = documents.filter("doc_id is not null").select(named(c("doc_id"), c("text")).alias("doc_id"), "text") if apart else documents
    kept = first_lines(given_ids, percent, min_words)
    rows = documents.select(F.struct("*").alias("row"))  # as a struct, so that no name clashes
    own = F.when(F.col("row.doc_id").isNotNull(), named(F.col("row.doc_id"), F.col("row.text"))) if apart else F.col("row.doc_id")
    joined = rows.join(kept, own == F.col("doc_id"), "left")
    given = F.col("row.text")
    stays = F.filter(F.split(given, "\n"), lambda x, i: ~enough(x, min_words) | F.coalesce(F.array_contains("kept", i), F.lit(False)))
    text = F.when(F.col("row.doc_id").isNull() | given.isNull(), given).otherwise(F.array_join(stays, "\n"))
    has_word = lambda c: F.rlike(F.coalesce(c, F.lit("")), F.lit(WORD))
    out = joined.select("row", text.alias("text")).filter(has_word(F.col("text")) | ~has_word(given))
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


OP9_SQL = r"""
with l as (select doc_id, unnest(range(len(string_split(text, chr(10))))) as line_no, unnest(string_split(text, chr(10))) as line from documents),
a as (select doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as w from l),
e as (select doc_id, line_no, list_sort(list_distinct(w)) as s from a where len(w) >= 1),
d as (select row_number() over () as id, s, len(s) as n, f from (select s, min((doc_id, line_no)) as f from e group by s)),
t as (select id, n, unnest(s) as t from d), c as (select t, count(*) as c from t group by t),
p as (select id, t from (select id, n, t, row_number() over (partition by id order by c, t) as k from t join c using (t)) where k <= n - ceil(n * 80 / 100) + 1),
q as (select distinct x.id as a, y.id as b from p x join p y on x.t = y.t and x.id <> y.id),
r as (select distinct a as id from q join d x on x.id = a join d y on y.id = b where y.f < x.f and least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 80
 and len(list_intersect(x.s, y.s)) * 100 >= (x.n + y.n - len(list_intersect(x.s, y.s))) * 80),
k as (select f[1] as doc_id, list(distinct f[2] order by f[2]) as kept from d where id not in (select id from r) group by 1),
g as (select doc_id, count(*) filter (len(w) > 0) as n_lines, count(*) filter (len(w) >= 1) as n_long from a group by doc_id)
select o.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_long, 0)::bigint as n_long, (coalesce(n_long, 0) - coalesce(len(kept), 0))::bigint as n_removed,
 coalesce(array_to_string(kept, ','), '') as kept_long from documents o left join g using (doc_id) left join k using (doc_id)
"""


#: The query has been over every line with a word since it began with five; the second name stays for those who use it.
op9_line_dedup_every_line = op9_line_dedup
OP9_EVERY_LINE_SQL = OP9_SQL
