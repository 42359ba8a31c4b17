"""Job advertisements of several sources: one schema, dedupe, tags."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..sources.io import written
from .keyed import first_by_key

c = F.col


#: The last day of the year 9999: a later Unix time is a mistake and gives null.
LAST_MILLIS = 253_402_300_799_999


def truthy(doc: Column, *keys: str) -> Column:
    """The first field of a parsed payload that isn't missing, empty, zero or false, as text.  doc: a variant, so no field parses the payload again."""
    some = lambda v: F.when(~v.isin("", "0", "0.0", "false"), v)
    return F.coalesce(*[text.bound(F.try_variant_get(doc, f"$.{k}", "string"), some) for k in keys])


def broken_payloads(raw: DataFrame) -> DataFrame:
    """The rows whose payload is no JSON object, or repeats a field; in unify_job_sources all their fields are null."""
    whole = F.coalesce(F.startswith(F.schema_of_variant(F.try_parse_json("payload")), F.lit("OBJECT")), F.lit(False))
    return raw.filter(~whole)


def unify_job_sources(raw: DataFrame) -> DataFrame:
    """Three payload shapes in one schema; rows of other sources are left out.  raw: id, source, payload (JSON), parsed once a row."""
    p = c("__doc")
    known = raw.filter(c("source").isin("indeed", "stepstone", "arbeitsagentur"))
    # a generator keeps later filters from being moved below the parser, where each field would parse again
    parsed = known.select(F.inline(F.array(F.struct("id", "source", F.try_parse_json("payload").alias("__doc")))))

    def pick(indeed: Sequence[str], stepstone: Sequence[str], agency: Sequence[str]) -> Column:
        parts = (("indeed", indeed), ("stepstone", stepstone), ("arbeitsagentur", agency))
        return F.coalesce(*[F.when(c("source") == s, truthy(p, *keys)) for s, keys in parts if keys])

    posted = pick(("datePosted", "postedAt", "postingDate"), ("publishDate", "publishDateISO", "postedDate"), ("posted_at",))
    millis, stamp = F.rlike(posted, F.lit(r"^\d{11,}$")), posted.try_cast("long")
    person = F.trim(F.concat_ws(" ", *[truthy(p, f"contact_{k}") for k in ("salutation", "firstname", "lastname")]))
    return parsed.select(
        "id", "source",
        pick(("company", "companyName"), ("company", "companyName", "employer"), ("company",)).alias("company"),
        pick(("title", "positionName", "jobTitle"), ("title", "jobTitle"), ("title",)).alias("title"),
        pick(("location",), ("city", "location"), ("location",)).alias("location"),
        pick(("jobUrl", "url", "externalApplyLink"), ("url", "jobUrl", "applyUrl"), ("source_url", "apply_url")).alias("link"),
        pick(("description", "descriptionText"), ("descriptionText", "description", "descriptionMarkdown", "summary"), ("description_full", "description_snippet")).alias("description"),
        F.when(millis, F.when(stamp.between(0, LAST_MILLIS), F.date_format(F.timestamp_millis(F.least(stamp, F.lit(LAST_MILLIS))), "yyyy-MM-dd"))).otherwise(posted).alias("posted"),
        F.when(c("source") == "arbeitsagentur", F.nullif(person, F.lit(""))).alias("contact"),
        F.when(c("source") == "arbeitsagentur", truthy(p, "contact_email", "apply_email")).alias("contact_email"),
        F.when(c("source") == "arbeitsagentur", truthy(p, "contact_phone")).alias("contact_phone"),
        F.coalesce(pick(("isRemote",), (), ("remote_option",)).isNotNull(), F.lit(False)).alias("remote_hint"),
    )


def external_id(source: Column, doc: Column) -> Column:
    """Each source's id, by its order of preference; null if it has none.  doc: the parsed payload (a variant)."""
    return (
        F.when(source == "indeed", truthy(doc, "jobId", "id", "jobUrl", "url"))
        .when(source == "stepstone", truthy(doc, "jobId", "id", "url", "jobUrl"))
        .when(source == "arbeitsagentur", truthy(doc, "id", "refnr", "source_url"))
    )


def lead_key(company: Column, title: Column) -> Column:
    return F.concat(text.norm_posting(F.trim(company)), F.lit("|"), text.norm_posting(F.trim(title)))


def dedupe_leads(mapped: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """Leads with company and title whose key isn't stored yet; the first of each key.  existing: dedupe_key."""
    named = mapped.filter((F.trim(text.text_or_empty(c("company"))) != "") & (F.trim(text.text_or_empty(c("title"))) != ""))
    keyed = named.withColumn("dedupe_key", lead_key(c("company"), c("title")))
    return first_by_key(keyed.join(existing, "dedupe_key", "left_anti"), ["dedupe_key"], [order])


def detect_city(location: Column) -> Column:
    """struct of in_target and city.  Excluded cities come first; a city counts wherever its name stands in the text."""
    fold = lambda city: unicodedata.normalize("NFKD", city).encode("ascii", "ignore").decode().lower()
    where = text.norm_posting(location)
    out, target = (text.first_of(where, [(x, fold(x)) for x in cities]) for cities in (config.EXCLUDED_CITIES, config.TARGET_CITIES))
    return F.struct((out.isNull() & target.isNotNull()).alias("in_target"), F.coalesce(out, target).alias("city"))


def is_remote(hint: Column, *texts: Column) -> Column:
    return F.coalesce(hint, F.lit(False)) | text.any_term(F.concat_ws(" ", *texts), config.REMOTE_HINTS)


def excluded_term(*texts: Column) -> Column:
    return text.first_term(F.concat_ws(" ", *[text.text_or_empty(t) for t in texts]), config.ACCOUNTING_TERMS)


def build_leads(mapped: DataFrame) -> DataFrame:
    """Tags, date and capped description of unified advertisements."""
    city = detect_city(c("location"))
    tagged = mapped.withColumn("where", city).withColumn("excluded", excluded_term(c("title"), c("description")))
    return tagged.select(
        "id", "source", F.trim("company").alias("company"), F.trim("title").alias("title"), "location", "where.in_target", "where.city", "excluded",
        is_remote(c("remote_hint"), c("title"), c("description"), c("location")).alias("remote"), posted_day(c("posted")).alias("posted_date"),
        F.substring(text.text_or_empty(c("description")), 1, 5000).alias("description"), "contact", "contact_email", "contact_phone",
    )


def posted_day(posted: Column) -> Column:
    return F.when(F.length(posted) >= 10, F.substring(posted, 1, 10))


def export_leads(leads: DataFrame, everything: bool = False, remote_only: bool = False) -> DataFrame:
    """Leads in a target city without an excluded term (or all), by company; stored, as a sort reads its rows twice."""
    chosen = leads if everything else leads.filter(c("in_target") & c("excluded").isNull())
    return written(chosen.filter("remote") if remote_only else chosen, "leads").orderBy("company", "id")


def extract_contacts(rows: DataFrame, body: str, email: str, phone: str, least: int = 30) -> DataFrame:
    """Fill empty e-mail and phone columns from texts that are long enough, wherever the contact stands in them."""
    head = F.when(F.length(c(body)) >= least, c(body))
    mail = F.nullif(F.regexp_extract(head, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0), F.lit(""))
    number = F.nullif(F.regexp_extract(head, r"\+\d[\d /()-]{6,}\d", 0), F.lit(""))
    return rows.withColumn(email, F.coalesce(F.nullif(c(email), F.lit("")), mail)).withColumn(phone, F.coalesce(F.nullif(c(phone), F.lit("")), number))
