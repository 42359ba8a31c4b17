"""Curation of leads, letters, calls and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..sources.io import written
from .keyed import first_by_key
from .keyed_table import removed, replace_partitions
from .search import containing

c = F.col
CLOSED = ("won", "rejected")
UNREACHED = ("nicht_erreicht", "falsche_nummer")
PRIORITIES = {0: "overdue", 1: "today", 2: "new", 3: "open", 4: "no reaction", 5: "closed"}
SUGGESTIONS = {"termin": "won", "kein_interesse": "rejected"}


def industry_code(wz: Column) -> Column:
    """The first two characters if both are digits, else ''."""
    return F.regexp_extract(F.trim(text.text_or_empty(wz)), r"^(\d\d)", 1)


def affinity(code: Column) -> Column:
    out = F.when(F.lit(False), "")
    for tier, codes in config.AFFINITY.items():
        out = out.when(code.isin(*codes), tier)
    return out.otherwise("mittel")


def is_consultant(code: Column) -> Column:
    return code.isin(*config.CONSULTANT_WZ)


def first_evidence(signals: DataFrame) -> DataFrame:
    """One quote of each company and type, the first; a blank type is ``sonstiges``."""
    kind = F.coalesce(F.nullif(c("signal_type"), F.lit("")), F.lit("sonstiges"))
    return first_by_key(signals.withColumn("signal_type", kind), ["company_id", "signal_type"], ["signal_id"]).select(
        "company_id", "signal_type", F.trim(text.text_or_empty(c("zitat"))).alias("zitat"), text.text_or_empty(c("url")).alias("url")
    )


def region_label(plz2: Column) -> Column:
    """A region's name, its two digits where it has none, ? without a postal code."""
    names = F.create_map(*[F.lit(x) for pair in config.REGION_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, plz2), F.nullif(plz2, F.lit("")), F.lit("?"))


def curation_frame(scores: DataFrame, companies: DataFrame, signals: DataFrame, handover: DataFrame, dossiers: DataFrame, people: DataFrame, files: DataFrame) -> DataFrame:
    """Scored companies that are open, with labels, flags, their dossier's main fields, their evidence and their people.

    companies: with holding_reason, dup_of, excluded, register_id and hr_amtsgericht; handover: key, handover; dossiers: company_id, d (parsed); people: key,
    people; files: key, file (the newest register file of a company, null where there is none).
    Evidence is an array sorted by type; people are an array, the oldest first; both are empty where nothing is known.
    """
    evidence = first_evidence(signals).groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("signal_type", "zitat", "url"))).alias("evidence"))
    firms = companies.filter(c("holding_reason").isNull() & c("dup_of").isNull() & ~F.coalesce("excluded", F.lit(False))).withColumnRenamed("id", "company_id").withColumn("key", text.company_key(c("name"), c("plz")))
    rows = scores.select("company_id", "score_klasse", "score_total", "cluster_branche", "gf_alter").join(firms.drop("gf_alter"), "company_id").join(dossiers.select("company_id", "d"), "company_id", "left")
    rows = rows.join(handover, "key", "left").join(people, "key", "left").join(files.select("key", "file"), "key", "left").join(evidence, "company_id", "left")
    code, plz2 = industry_code(c("branche_wz")), F.regexp_extract(F.trim(text.text_or_empty(c("plz"))), r"^(\d\d)", 1)
    kilo = lambda x: F.bround(x / 1000).try_cast("long")
    yes = lambda col: F.coalesce(col, F.lit(False))
    none = lambda name: F.coalesce(c(name), F.array().cast(rows.schema[name].dataType)).alias(name)
    pain = F.create_map(*[F.lit(x) for pair in config.PAIN_POINTS.items() for x in pair])
    return rows.select(
        "company_id", "name", "plz", "ort", plz2.alias("plz2"), region_label(plz2).alias("region"), affinity(code).alias("affinity"), is_consultant(code).alias("consultant"), c("cluster_branche").alias("cluster"),
        c("score_klasse").alias("klasse"), c("score_total").alias("score"), "gf_alter", yes(c("handover")).alias("handover"), kilo(c("umsatz_eur")).alias("revenue_k"), kilo(c("bilanzsumme_eur")).alias("balance_k"),
        yes(c("d.familienunternehmen.hinweis")).alias("family"), yes(c("d.nachfolge_intern_geregelt")).alias("settled"), text.text_or_empty(c("d.naechste_generation")).alias("next_generation"),
        F.array_join(F.coalesce("d.nachfolge_signale", F.array().cast("array<string>")), "; ").alias("succession_signs"), text.text_or_empty(c("d.geschaeftsmodell")).alias("business_model"),
        c("d.fuehrungsstruktur.kaufmaennische_funktion_besetzt").alias("commercial_role_filled"), c("d.fuehrungsstruktur.zweite_ebene_sichtbar").alias("second_level"),
        F.coalesce("d.karriere.kaufm_stellen", F.array().cast("array<string>")).alias("commercial_jobs"), F.coalesce("d.ansprache_hooks", F.array().cast("array<string>")).alias("hooks"),
        text.text_or_empty(F.try_element_at(pain, c("cluster_branche"))).alias("pain_point"), none("people"), none("evidence"), F.coalesce(F.size("evidence"), F.lit(0)).alias("n_evidence"),
        text.text_or_empty(c("register_id")).alias("register_id"), text.text_or_empty(c("hr_amtsgericht")).alias("court"), "file",
    )


def curation_filter(
    frame: DataFrame, *, plz2: Sequence[str] | None = None, affinity: Sequence[str] | None = None, clusters: Sequence[str] | None = None, without_consultants: bool = True, classes: Sequence[str] = ("A", "B"), show_settled: bool = False,
    min_age: int = 58, unknown_age: bool = False, revenue_k: tuple[int, int] | None = None, balance_k: tuple[int, int] | None = None, unknown_size: bool = True, search: str = "", reviews: DataFrame | None = None, review_status: str = "alle", leads_only: bool = False,
) -> DataFrame:
    """The rows that pass every mask, sorted by class, falling score and age.  What is unknown only passes where it is asked for.

    A succession that is settled (so says the dossier, or the generations have changed) hides a company, or shows it beside the classes.
    """
    no = lambda mask: F.coalesce(mask, F.lit(False))
    rows = frame
    for col, values in (("plz2", plz2), ("affinity", affinity), ("cluster", clusters)):
        if values is not None:
            rows = rows.filter(c(col).isin(*values))
    if without_consultants:
        rows = rows.filter(~c("consultant"))
    of_class, settled = c("klasse").isin(*classes), c("settled") | c("handover")
    rows = rows.filter(of_class | settled if show_settled else of_class & ~settled)
    rows = rows.filter(no(c("gf_alter") >= min_age) | (F.lit(unknown_age) & c("gf_alter").isNull()))
    for col, limits in (("revenue_k", revenue_k), ("balance_k", balance_k)):
        if limits:
            rows = rows.filter(no(c(col).between(*limits)) | (F.lit(unknown_size) & c(col).isNull()))
    if search.strip():
        word = F.lit(search.strip().lower())
        rows = rows.filter(F.contains(F.lower("name"), word) | no(F.contains(F.lower("ort"), word)))
    if reviews is not None:
        rows = rows.join(reviews.select("company_id", "decision"), "company_id", "left")
        done = no(c("decision").isin("lead", "uninteressant"))
        if review_status != "alle":
            rows = rows.filter(done if review_status == "bearbeitet" else ~done)
        if leads_only:
            rows = rows.filter(no(c("decision") == "lead"))
    return rows.orderBy("klasse", F.desc_nulls_last("score"), F.desc_nulls_last("gf_alter"), "company_id")


def reviews_of_wave(new: DataFrame, wave: int) -> DataFrame:
    """The rows to store for a wave: those that hold a decision or a note."""
    decision, note = F.nullif(c("decision"), F.lit("")), F.trim(text.text_or_empty(c("note_self")))
    rows = new.filter(decision.isNotNull() | (note != ""))
    return rows.select("company_id", F.lit(wave).alias("wave"), decision.alias("decision"), F.coalesce(decision == "lead", F.lit(False)).alias("selected"), note.alias("note_self"))


def merge_reviews(existing: DataFrame, new: DataFrame, wave: int) -> DataFrame:
    """existing with the rows of one wave replaced by the new ones that hold a decision or a note."""
    kept = reviews_of_wave(new, wave)
    return existing.filter(c("wave") != wave).select(*kept.columns).unionByName(kept)


def write_wave(path: str, new: DataFrame, wave: int) -> None:
    """The same in a stored table partitioned by wave: only that wave is written; all rows of it go if none of the new ones holds anything."""
    kept = written(reviews_of_wave(new, wave), "wave")
    if kept.isEmpty():
        removed(new.sparkSession, f"{path}/wave={wave}")
    else:
        replace_partitions(kept, path, "wave")


def is_lead(decision: Column, selected: Column) -> Column:
    """Old rows have no decision but are selected."""
    return F.coalesce(decision == "lead", F.coalesce(selected, F.lit(False)))


def leads_by_wave(selection: DataFrame) -> DataFrame:
    return selection.filter(is_lead(c("decision"), c("selected"))).select("wave", "company_id").distinct()


def reconcile_letters(letters: DataFrame, companies: DataFrame, selection: DataFrame) -> DataFrame:
    """state and n of printed letters (name): matched to a lead, to a company that is none any more, or to nothing.

    A letter counts once for each company of its name; both are counted by name before they meet, so that a name that many share is one row of either.
    """
    leads = leads_by_wave(selection).select("company_id", F.lit(True).alias("lead")).distinct()
    state = F.when(c("company_id").isNull(), "unmatched").when(c("lead").isNull(), "dropped").otherwise("lead")
    firms = companies.select("name", c("id").alias("company_id")).join(leads.hint("merge"), "company_id", "left").groupBy("name", state.alias("state")).agg(F.count("*").alias("firms"))
    printed = letters.groupBy("name").agg(F.count("*").alias("letters"))
    met = printed.join(firms, "name", "left").withColumn("state", F.coalesce("state", F.lit("unmatched")))
    return met.groupBy("state").agg(F.sum(c("letters") * F.coalesce("firms", F.lit(1))).alias("n"))


def queue_letters(existing: DataFrame, ids: DataFrame, wave: int) -> DataFrame:
    """existing (company_id, channel, wave, status) with a queued letter for each company that has none in the wave."""
    fresh = ids.select("company_id").distinct().select("company_id", F.lit("letter").alias("channel"), F.lit(wave).alias("wave"), F.lit("queued").alias("status"))
    return existing.select(*fresh.columns).unionByName(fresh.join(existing, ["company_id", "channel", "wave"], "left_anti"))


def contact_state(leads: DataFrame, outreach: DataFrame, calls: DataFrame, today: str) -> DataFrame:
    """Per lead: letter and mail status, number of calls, whether anybody was reached, last outcome, follow-up day, priority."""
    letter = outreach.filter("channel = 'letter'").groupBy("company_id").agg(F.max_by("status", "outreach_id").alias("status"))
    mail = outreach.filter("channel = 'email'").groupBy("company_id").agg(F.max_by("status", "outreach_id").alias("mail"))
    when = F.struct("called_at", "call_id")
    own = calls.groupBy("company_id").agg(
        F.count("*").alias("n_calls"), F.bool_or(~c("outcome").isin(*UNREACHED)).alias("reached"), F.max_by("outcome", when).alias("last_outcome"),
        F.max(F.when(c("follow_up_at").isNotNull(), F.struct("called_at", "call_id", "follow_up_at")))["follow_up_at"].alias("follow_up"),
    )
    day = F.lit(today).cast("date")
    priority = (
        F.when(c("status").isin(*CLOSED), 5).when(c("follow_up") < day, 0).when(c("follow_up") == day, 1).when(c("n_calls").isNull(), 2).when(c("status") == "no_response", 4).otherwise(3)
    )
    joined = leads.join(letter, "company_id", "left").join(mail, "company_id", "left").join(own, "company_id", "left")
    return joined.withColumn("priority", priority)


def funnel_kpis(leads: DataFrame, outreach: DataFrame, calls: DataFrame, today: str) -> DataFrame:
    s = contact_state(leads, outreach, calls, today)
    closed, due = F.coalesce(c("status").isin(*CLOSED), F.lit(False)), F.coalesce(c("follow_up") <= F.lit(today).cast("date"), F.lit(False))
    return s.agg(
        F.count("*").alias("leads"), F.count("status").alias("letters"), F.count_if(c("status") != "queued").alias("sent"), F.count_if(c("mail") == "sent").alias("mails"), F.count("n_calls").alias("called"), F.count_if("reached").alias("reached"),
        F.count_if(due & ~closed).alias("due"), F.count_if(c("status") == "won").alias("won"), F.count_if(c("status") == "rejected").alias("lost"), F.count_if(~closed).alias("open"),
    )


def work_list(leads: DataFrame, outreach: DataFrame, calls: DataFrame, today: str, open_only: bool = True) -> DataFrame:
    """Leads (company_id, name, score) in the order in which to call them."""
    s = contact_state(leads, outreach, calls, today)
    rows = s.filter("priority < 5") if open_only else s
    return rows.orderBy("priority", F.desc(F.coalesce("score", F.lit(-1))), F.lower("name"), "company_id")


def mark_sent(outreach: DataFrame, wave: int, day: str) -> DataFrame:
    """The wave's queued letters are sent on the day; all other rows stay as they are."""
    hit = F.coalesce((c("channel") == "letter") & (c("wave") == wave) & (c("status") == "queued"), F.lit(False))
    before = c("sent_at") if "sent_at" in outreach.columns else F.lit(None).cast("date")
    sent = F.when(hit, F.lit(day).cast(outreach.schema["sent_at"].dataType if "sent_at" in outreach.columns else "date")).otherwise(before)
    return outreach.withColumn("sent_at", sent).withColumn("status", F.when(hit, "sent").otherwise(c("status")))


def suggest_disposition(calls: DataFrame) -> DataFrame:
    """company_id and the status that its last call suggests."""
    last = calls.groupBy("company_id").agg(F.max_by("outcome", F.struct("called_at", "call_id")).alias("outcome"))
    pairs = F.create_map(*[F.lit(x) for kv in SUGGESTIONS.items() for x in kv])
    return last.select("company_id", F.try_element_at(pairs, c("outcome")).alias("suggestion")).filter("suggestion is not null")


def lead_list(outreach: DataFrame, companies: DataFrame, scores: DataFrame, wave: int, channel: str, status: Sequence[str] | None = None, sort: str = "stadt") -> DataFrame:
    """One row for each message of a wave, with company, industry label and score (-1 if missing)."""
    rows = outreach.filter((c("channel") == channel) & (c("wave") == wave))
    if status:
        rows = rows.filter(c("status").isin(*status))
    firms = companies.select(c("id").alias("company_id"), "name", "ort", "branche_wz")
    joined = rows.select("company_id", "status").join(firms, "company_id", "left").join(scores.select("company_id", "cluster_branche", "score_total"), "company_id", "left")
    out = joined.select(
        "company_id", F.trim(text.text_or_empty(c("name"))).alias("firma"), text.short_industry(c("branche_wz"), c("cluster_branche")).alias("branche"), F.trim(text.text_or_empty(c("ort"))).alias("stadt"),
        F.coalesce("score_total", F.lit(-1)).alias("score"), "status",
    )
    name = F.lower("firma")
    orders = {"score": [F.desc("score"), name], "firma": [name], "stadt": [F.lower("stadt"), name]}
    return out.orderBy(*orders[sort], "company_id")


def apply_by_substring(companies: DataFrame, overrides: DataFrame) -> DataFrame:
    """id and value of the first override (by ord) whose key the company's name contains.  overrides: ord, key, value, however many.

    Each different name meets the first override of each different key; the companies of a name get what it has found.
    """
    firsts = overrides.groupBy("key").agg(F.min_by("value", "ord").alias("value"), F.min("ord").alias("ord"))
    hits = containing(companies.select("name").distinct(), "name", firsts, "key")
    found = hits.groupBy("name").agg(F.min_by("value", "ord").alias("value"), F.min("ord").alias("ord"))
    return companies.select("id", "name").join(found.hint("merge"), "name").groupBy("id").agg(F.min_by("value", "ord").alias("value"))


def salutation(companies: DataFrame, directors: DataFrame, genders: DataFrame, old_age: int = 75) -> DataFrame:
    """id, address, name line, salutation and flags.  directors: from oldest_director; genders: first_name, gender (m or f)."""
    rows = companies.select("id", text.norm_company_legacy(c("name")).alias("key")).join(directors, "key", "left")
    given = F.lower(F.split_part(F.split_part(text.text_or_empty(c("first")), F.lit(" "), F.lit(1)), F.lit("-"), F.lit(1)))
    rows = rows.withColumn("given", given).join(genders.select(F.lower("first_name").alias("given"), "gender"), "given", "left")
    known, man = c("age").isNotNull(), F.coalesce(c("gender"), F.lit("m")) == "m"
    title = F.when(text.text_or_empty(c("title")) != "", F.concat("title", F.lit(" "))).otherwise("")
    flags = F.array(F.when(~known, "no director"), F.when(known & c("gender").isNull(), "gender unknown"), F.when(c("age") >= old_age, "very old"))
    return rows.select(
        "id", F.when(known, F.when(man, "Herrn").otherwise("Frau")).alias("address"), F.when(known, F.trim(F.concat(title, "first", F.lit(" "), "last"))).otherwise("").alias("name_line"),
        F.when(known, F.concat(F.when(man, "Sehr geehrter Herr ").otherwise("Sehr geehrte Frau "), title, "last", F.lit(","))).otherwise("Sehr geehrte Damen und Herren,").alias("salutation"),
        F.array_join(F.filter(flags, lambda x: x.isNotNull()), "; ").alias("flags"),
    )
