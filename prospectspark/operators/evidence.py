"""Evidence: what goes into a model call and what comes out of it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..sources.io import written
from .scoring import crawl_candidates, open_companies, parse_dossier
from .search import grams

c = F.col


def extract_candidates(companies: DataFrame, dossiers: DataFrame, with_text: DataFrame, min_score: float | None = None, limit: int | None = None) -> DataFrame:
    """Reachable companies with text and without dossier, best first, and the task's tier by rounded priority."""
    reachable = F.coalesce(F.get_json_object("tech_signals", "$.reachable") == "true", F.lit(False))
    ready = open_companies(companies).filter(reachable).join(with_text.select(c("company_id").alias("id")).distinct(), "id", "left_semi").join(dossiers.select(c("company_id").alias("id")), "id", "left_anti")
    rated = F.coalesce(F.bround("prioritaets_score"), F.lit(2.0))
    rows = ready.withColumn("tier", F.when(rated <= 1, "low").otherwise("high"))
    return crawl_candidates(rows, min_score=min_score, force=True, limit=limit)


def filled_in(pattern: str, **values: Column) -> Column:
    """A text with {names} replaced by columns; null counts as empty."""
    parts = re.split(r"\{(\w+)\}", pattern)
    return F.concat(*[text.text_or_empty(values[p].cast("string")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def context_head(companies: DataFrame) -> DataFrame:
    """company_id and the head of its context.  companies: id, name, plz, ort, branche_wz, vertreter_1 and, if known, gegenstand."""
    fields = {n: c(n) if n in companies.columns else F.lit("") for n in ("name", "plz", "ort", "branche_wz", "gegenstand", "vertreter_1")}
    fields["gegenstand"] = F.coalesce(F.nullif(text.text_or_empty(fields["gegenstand"]), F.lit("")), F.lit(config.CONTEXT_NONE))
    return companies.select(c("id").alias("company_id"), filled_in(config.CONTEXT_HEAD, **fields).alias("head"))


def assemble_context(pages: DataFrame, companies: DataFrame, priority: Sequence[str], max_chars: int) -> DataFrame:
    """company_id and its context: the head, then its page blocks by type priority, blank pages left out.

    The head counts towards the budget; the block that crosses it is cut and ends the context.  pages: company_id, page_id, page_type, url, text_content.
    Lengths are summed before any text is joined.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, priority)), c("page_type")).cast("int"), F.lit(0))
    rank = F.when(rank == 0, len(priority) + 1).otherwise(rank)
    body = F.regexp_replace("text_content", r"(?U)^\s+|\s+$", "")
    block = filled_in(config.CONTEXT_BLOCK, page_type=c("page_type"), url=c("url"), text=body)
    heads = context_head(companies)
    rows = pages.filter(text.collapse(text.text_or_empty(c("text_content"))) != "").withColumn("rank", rank)
    before = Window.partitionBy("company_id").orderBy("rank", "page_id").rowsBetween(Window.unboundedPreceding, -1)
    sized = rows.select("company_id", "page_id", "rank", F.length(block).alias("n")).join(heads.select("company_id", F.length("head").alias("used")), "company_id")
    spent = sized.withColumn("before", c("used") + F.coalesce(F.sum("n").over(before), F.lit(0))).filter(c("before") < max_chars)
    kept = spent.drop("rank").join(rows, ["company_id", "page_id"])
    cut = F.substring(block, F.lit(1), (F.lit(max_chars) - c("before")).cast("int"))
    blocks = kept.groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("rank", "page_id", cut.alias("b")))).alias("blocks"))
    joined = heads.join(blocks, "company_id", "left")
    return joined.select("company_id", F.concat("head", text.text_or_empty(F.array_join(F.transform("blocks", lambda b: b["b"]), ""))).alias("context"))


def parse_dossiers(raw: DataFrame, json: str = "dossier_json") -> DataFrame:
    """company_id, d (the dossier as a struct) and error for text that isn't a JSON object."""
    parsed = raw.select("company_id", c(json).alias("j"), parse_dossier(c(json)).alias("d"))
    broken = F.get_json_object("j", "$").isNull() | ~F.startswith(F.trim("j"), F.lit("{"))
    return parsed.select("company_id", "d", F.when(F.coalesce(broken, F.lit(True)), "not a JSON object").alias("error"))


def has_source() -> Column:
    """Only a quote with text and url is evidence."""
    return (text.collapse(text.text_or_empty(c("zitat"))) != "") & (text.collapse(text.text_or_empty(c("url"))) != "")


def evidence_counts(quotes: DataFrame) -> DataFrame:
    """company_id, n_signals (quotes that are kept) and dropped."""
    return quotes.groupBy("company_id").agg(F.count_if(has_source()).alias("n_signals"), F.count_if(~has_source()).alias("dropped"))


def evidence_rows(quotes: DataFrame) -> DataFrame:
    """Quotes with text and url, a blank type as ``sonstiges``.  quotes: company_id, signal_type, zitat, url."""
    return quotes.filter(has_source()).withColumn("signal_type", F.coalesce(F.nullif(F.trim(text.text_or_empty(c("signal_type"))), F.lit("")), F.lit("sonstiges")))


def dossier_quotes(dossiers: DataFrame) -> DataFrame:
    """company_id, signal_type, zitat, url of every piece of evidence of parsed dossiers."""
    return dossiers.select("company_id", F.explode("d.belege").alias("b")).select("company_id", "b.signal_type", "b.zitat", c("b.quelle_url").alias("url"))


def evidence_signals(existing: DataFrame, processed: DataFrame, quotes: DataFrame) -> DataFrame:
    """existing without the processed companies, and their new rows."""
    cols = ["company_id", "signal_type", "zitat", "url"]
    return existing.select(cols).join(processed.select("company_id").distinct(), "company_id", "left_anti").unionByName(evidence_rows(quotes).select(cols))


#: Words of a window that must stand in a row, and characters of a shorter quote.
WINDOW, LEAST = 6, 8
#: Bits of the filter of a company's anchors, whatever their number.
FILTER_BITS = 1024


def normed_quotes(quotes: DataFrame) -> DataFrame:
    """quote_id, company_id, quote: lower-cased, white space collapsed, without the marks around it."""
    quote = F.btrim(text.norm_ws(c("zitat")), F.lit(" \"'.,;:!?-"))
    return written(quotes.select(F.monotonically_increasing_id().alias("quote_id"), "company_id", quote.alias("quote")), "quotes")


def stretches(words: Column, n: int) -> Column:
    """Every n words in a row, with the words around them: n, body, before, after ('' at the ends)."""
    at = lambda i: text.text_or_empty(F.get(words, i))
    one = lambda i: F.struct(F.lit(n).alias("n"), F.array_join(F.slice(words, i + 1, n), " ").alias("body"), F.when(i > 0, at(i - 1)).otherwise("").alias("before"), at(i + n).alias("after"))
    count = F.size(words) - n + 1
    return F.when(count >= 1, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), one)).otherwise(F.array().cast("array<struct<n:int,body:string,before:string,after:string>>"))


def filter_place(body: Column) -> Column:
    return F.pmod(F.xxhash64(body), F.lit(FILTER_BITS)).cast("int")


def anchor_filters(asked: DataFrame) -> DataFrame:
    """company_id and mask: the bits that its anchors (body) set, as a map of at most FILTER_BITS / 64 numbers."""
    place = filter_place(c("body"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))
    marks = asked.groupBy("company_id", F.shiftright(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits"))
    return marks.groupBy("company_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "bits"))).alias("mask"))


def may_be_anchor(mask: Column, body: Column) -> Column:
    """False only where no anchor of the company equals the body."""
    bits = lambda p: F.coalesce(F.call_function("shiftrightunsigned", F.try_element_at(mask, F.shiftright(p, 6)), p.bitwiseAND(63)).bitwiseAND(1) == 1, F.lit(False))
    return text.bound(filter_place(body), bits)


def found_quotes(quotes: DataFrame, texts: DataFrame) -> DataFrame:
    """quote_id of the quotes that stand in their company's text: any WINDOW words in a row of a longer one, a shorter one as a whole.

    A stretch is a substring, so its first word may be the end of a longer word and its last one the beginning of one; what lies between are whole words.
    These are the anchor: quotes and texts meet by company and anchor, and the two words at the ends are compared where they meet.  Quotes of one or two
    words have no whole word inside; they are anchored by their longest word's four characters next to the seam, or by the first LEAST characters of a
    word.  So no text is copied for each quote.  A filter of fixed size drops the stretches that no quote of the company asks for before they are shuffled; no side is
    sent to all tasks, however small its file is.  quotes: quote_id, company_id, quote; texts: company_id, body (normalised).
    """
    parts = F.split("quote", " ")
    size = F.when(c("quote") == "", 0).otherwise(F.size(parts))
    rows = quotes.select("quote_id", "company_id", "quote", parts.alias("w"), size.alias("size"))
    # windows of a long quote, the whole of a short one with at least three words
    width = F.least(c("size"), F.lit(WINDOW))
    starts = F.sequence(F.lit(0), c("size") - width)
    window = lambda i: F.struct((width - 2).alias("n"), F.array_join(F.slice("w", i + 2, width - 2), " ").alias("body"), F.get("w", i).alias("first"), F.get("w", i + width - 1).alias("last"))
    asked = rows.filter((c("size") >= 3) & ((c("size") >= WINDOW) | (F.length("quote") >= LEAST))).select("quote_id", "company_id", F.explode(F.transform(starts, window)).alias("q")).select("quote_id", "company_id", "q.*")
    words = texts.select("company_id", F.split("body", " ").alias("t"))
    held = F.flatten(F.array(*[stretches(c("t"), n) for n in range(1, WINDOW - 1)]))
    wanted = words.join(anchor_filters(asked).hint("merge"), "company_id").select("company_id", F.explode(F.filter(held, lambda s: may_be_anchor(c("mask"), s["body"]))).alias("s"))
    met = asked.join(wanted.select("company_id", "s.*").hint("merge"), ["company_id", "n", "body"])
    long_ = met.filter(F.endswith("before", c("first")) & F.startswith("after", c("last"))).select("quote_id")
    # two words: the seam between them; one word: inside a word
    first, last = F.get("w", F.lit(0)), F.get("w", F.lit(1))
    tail = F.length(first) >= 4
    two = rows.filter((c("size") == 2) & (F.length("quote") >= LEAST)).select("quote_id", "company_id", tail.alias("tail"), F.when(tail, F.right(first, F.lit(4))).otherwise(F.left(last, F.lit(4))).alias("seam"), first.alias("first"), last.alias("last"))
    pairs = words.select("company_id", F.explode(stretches(c("t"), 1)).alias("s")).filter("s.after != ''").select("company_id", c("s.body").alias("left"), c("s.after").alias("right"))
    seams = pairs.select("*", F.inline(F.array(F.struct(F.lit(True).alias("tail"), F.right("left", F.lit(4)).alias("seam")), F.struct(F.lit(False).alias("tail"), F.left("right", F.lit(4)).alias("seam")))))
    short = two.join(seams.distinct().hint("merge"), ["company_id", "tail", "seam"]).filter(F.endswith("left", c("first")) & F.startswith("right", c("last"))).select("quote_id")
    one = rows.filter((c("size") == 1) & (F.length("quote") >= LEAST)).select("quote_id", "company_id", "quote", F.left("quote", F.lit(LEAST)).alias("gram"))
    single = words.select("company_id", F.explode("t").alias("word")).filter(F.length("word") >= LEAST).distinct().withColumn("gram", F.explode(grams(c("word"), LEAST)))
    inside = one.join(single.hint("merge"), ["company_id", "gram"]).filter(F.contains("word", c("quote"))).select("quote_id")
    return long_.unionByName(short).unionByName(inside).distinct()


def quote_fidelity(quotes: DataFrame, texts: DataFrame) -> DataFrame:
    """company_id, total and ok quotes.  quotes: company_id, zitat; texts: company_id, body, one row each.

    Marks around a quote don't count; a quote without words counts in the total and is not found.
    """
    rows = normed_quotes(quotes)
    bodies = texts.select("company_id", text.norm_ws(c("body")).alias("body"))
    found = found_quotes(rows, bodies).withColumn("hit", F.lit(True))
    return rows.join(found.hint("merge"), "quote_id", "left").groupBy("company_id").agg(F.count("*").alias("total"), F.count("hit").alias("ok"))


def fields_filled(dossiers: DataFrame) -> DataFrame:
    """company_id and how many top-level fields hold something: a list with entries, a struct with a set value, a scalar that isn't '', false or 0."""
    from pyspark.sql import types as T

    schema = dossiers.schema["d"].dataType

    def filled(path: str, kind: T.DataType) -> Column:
        col = c(path)
        if isinstance(kind, T.ArrayType):
            return F.size(col) > 0
        if isinstance(kind, T.StructType):
            out = F.lit(False)
            for f in kind:
                out |= filled(f"{path}.{f.name}", f.dataType)
            return out
        if isinstance(kind, T.BooleanType):
            return F.coalesce(col, F.lit(False))
        return F.coalesce(~col.cast("string").isin("", "0"), F.lit(False))

    count = sum((F.coalesce(filled(f"d.{f.name}", f.dataType), F.lit(False)).cast("int") for f in schema), F.lit(0))
    return dossiers.select("company_id", count.alias("filled"))


def extraction_report(audit: DataFrame) -> DataFrame:
    """Per backend: calls, successes, retries, tokens, share of quotes found.  audit: backend, ok, retries, tokens, quotes, quotes_ok."""
    return audit.groupBy("backend").agg(
        F.count("*").alias("calls"), F.count_if("ok").alias("succeeded"), F.sum("retries").alias("retries"), F.sum("tokens").alias("tokens"), F.round(F.sum("quotes_ok") / F.nullif(F.sum("quotes"), F.lit(0)), 6).alias("fidelity"),
        F.count_if(c("quotes") == 0).alias("without_quotes"),
    )


def extraction_summary(audit: DataFrame) -> DataFrame:
    """One row over all calls; sums and averages are over those that succeeded.

    audit: ok, retries, escalated, tokens_in, tokens_out, seconds, filled, quotes, quotes_ok, n_signals, dropped.
    """
    done = lambda col: F.when(c("ok"), col)
    counts = {"succeeded": c("ok"), "failed": ~F.coalesce(c("ok"), F.lit(False)), "repaired": c("ok") & (c("retries") > 0), "escalated": c("ok") & c("escalated")}
    total = lambda name: F.coalesce(F.sum(done(c(name))), F.lit(0)).alias(name)
    mean = lambda name: F.round(F.avg(done(c(name))), 6).alias(f"{name}_mean")
    return audit.agg(
        F.count("*").alias("n"), *[F.count_if(hit).alias(name) for name, hit in counts.items()], total("tokens_in"), total("tokens_out"), mean("seconds"), mean("filled"), mean("quotes"),
        F.round(F.sum(done(c("quotes_ok"))) / F.nullif(F.sum(done(c("quotes"))), F.lit(0)), 6).alias("fidelity"), F.count_if(c("ok") & (c("quotes") == 0)).alias("without_quotes"), total("n_signals"), total("dropped"),
    )


def blind_sample(scores: DataFrame, per_cluster: int) -> DataFrame:
    """Scored companies: per cluster the classes A, B, C in turn, each in the order of a hash of the id; a label by the hash's parity."""
    h = F.sha2(c("company_id").cast("string"), 256)
    rows = scores.filter(c("score_klasse").isin("A", "B", "C")).withColumn("h", h)
    inner = rows.withColumn("turn", F.row_number().over(Window.partitionBy("cluster_branche", "score_klasse").orderBy("h")))
    ranked = inner.withColumn("place", F.row_number().over(Window.partitionBy("cluster_branche").orderBy("turn", "score_klasse"))).filter(c("place") <= per_cluster)
    odd = F.instr(F.lit("13579bdf"), F.substring("h", -1, 1)) > 0
    return ranked.select("cluster_branche", "place", "company_id", "score_klasse", F.when(odd, "B").otherwise("A").alias("label"))


def compare_backends(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row for each measure, one column for each backend, over the companies that all of them did.  records: company_id, backend, quotes_ok, filled, seconds."""
    shared = records.groupBy("company_id").agg(F.count_distinct("backend").alias("k")).filter(c("k") == len(names)).select("company_id")
    sums = records.join(shared, "company_id", "left_semi").groupBy("backend").agg(F.sum("quotes_ok").cast("double").alias("quotes_ok"), F.sum("filled").cast("double").alias("filled"), F.sum("seconds").cast("double").alias("seconds"))
    return sums.unpivot("backend", ["quotes_ok", "filled", "seconds"], "measure", "value").groupBy("measure").pivot("backend", list(names)).agg(F.first("value"))


