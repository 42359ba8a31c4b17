"""Text, host and date columns.  Column in, Column out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from .helpers import ascii_fold


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def collapse(c: Column) -> Column:
    """Runs of Unicode white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_ws(c: Column) -> Column:
    return collapse(F.lower(text_or_empty(c)))


def norm_text(c: Column) -> Column:
    """Lower, ASCII, everything else than letters and digits to blanks."""
    folded = ascii_fold(F.replace(F.lower(text_or_empty(c)), F.lit("ß"), F.lit("ss")))
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def norm_company(c: Column) -> Column:
    """norm_text without legal-form phrases."""
    padded = F.concat(F.lit(" "), norm_text(c), F.lit(" "))
    for phrase in config.LEGAL_PHRASES:
        padded = F.replace(padded, F.lit(f" {phrase} "), F.lit(" "))
    return F.trim(padded)


def norm_posting(c: Column) -> Column:
    return F.lower(collapse(ascii_fold(text_or_empty(c))))


def norm_company_legacy(c: Column) -> Column:
    out = ascii_fold(F.lower(text_or_empty(c)))
    for part in config.LEGACY_SUBSTRINGS:
        out = F.replace(out, F.lit(part), F.lit(" "))
    return collapse(out)


def company_key(name: Column, plz: Column) -> Column:
    return F.concat_ws("|", norm_ws(name), F.trim(text_or_empty(plz)))


def repost_key(employer: Column, title: Column) -> Column:
    return F.struct(norm_company(employer).alias("employer"), norm_text(title).alias("title"))


def wz_code(c: Column) -> Column:
    return F.regexp_extract(text_or_empty(c), r"^\s*(\d{2}(?:\.\d+)*)", 1)


def wz2(c: Column) -> Column:
    return F.regexp_extract(text_or_empty(c), r"^\s*(\d{2})", 1)


def normalize_host(url: Column) -> Column:
    """Authority of the url, port included; the path if there is none."""
    given = F.trim(text_or_empty(url))
    full = F.when(F.contains(given, F.lit("//")), given).otherwise(F.concat(F.lit("http://"), given))
    host = F.regexp_extract(full, r"//([^/?#]*)", 1)
    path = F.regexp_extract(full, r"//[^/?#]*([^?#]*)", 1)
    return F.lower(F.btrim(F.when(host != "", host).otherwise(path), F.lit("/")))


def registrable(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def same_site(url: Column, host: Column) -> Column:
    own = normalize_host(url)
    return (own == "") | (registrable(own) == registrable(host))


def year_of(c: Column) -> Column:
    first = F.substring(F.trim(text_or_empty(c)), 1, 4)
    return F.when(F.rlike(first, F.lit(r"^\d{4}$")), F.nullif(first.cast("int"), F.lit(0)))


def year_in_text(c: Column) -> Column:
    return F.nullif(F.regexp_extract(text_or_empty(c), r"(20\d{2})", 1), F.lit("")).cast("int")


def format_de_date(c: Column) -> Column:
    return F.coalesce(F.date_format(F.try_to_timestamp(c), "dd.MM.yyyy"), F.substring(c, 1, 10))


def phone_digits(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), r"[^0-9+]", "")


def slug(c: Column) -> Column:
    return F.substring(F.btrim(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", "-"), F.lit("-")), 1, 40)


def short_industry(wz: Column, cluster: Column, most: int = 44) -> Column:
    """The industry's text without its code, cut at a word; without text the cluster's label."""
    text = F.trim(F.regexp_replace(F.trim(text_or_empty(wz)), r"^\s*\d+(?:\.\d+)*\s*", ""))
    labels = F.create_map(*[F.lit(x) for pair in config.CLUSTER_LABELS.items() for x in pair])
    label = F.coalesce(F.try_element_at(labels, text_or_empty(cluster)), F.replace(text_or_empty(cluster), F.lit("_"), F.lit(" ")))
    head = F.substring(text, 1, most)
    at_word = F.regexp_extract(head, r"^(.+) [^ ]*$", 1)
    cut = F.regexp_replace(F.when(at_word != "", at_word).otherwise(head), "[ ,-]+$", "")
    return F.when(text == "", label).when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit("…")))


def age_priority(age: Column) -> Column:
    return F.when(age.isNull(), "unbekannt").when(age >= 58, "hoch").when(age >= 50, "mittel").otherwise("niedrig")


def split_title(first: Column, last: Column) -> Column:
    """struct of first and last name without academic titles, and the titles found."""
    both = F.concat_ws(" ", text_or_empty(first), text_or_empty(last))
    found = F.array_join(F.filter(F.array(*map(F.lit, config.TITLES)), lambda t: F.contains(both, t)), " ")

    def without(c: Column) -> Column:
        for t in config.TITLES:
            c = F.replace(c, F.lit(t), F.lit(""))
        return collapse(c)

    return F.struct(without(text_or_empty(first)).alias("first"), without(text_or_empty(last)).alias("last"), found.alias("title"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def any_term(text: Column, terms: Sequence[str]) -> Column:
    """Whether one of the terms occurs, capitals aside."""
    low = F.array(*[F.lit(t.lower()) for t in terms])
    return bound(F.lower(text_or_empty(text)), lambda v: F.exists(low, lambda t: F.contains(v, t)))


def first_of(text: Column, parts: Sequence[tuple[str, str]]) -> Column:
    """The name of the first (name, part) whose part occurs in the text as it is; else null."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("part")) for n, p in parts])
    return bound(text, lambda v: F.get(F.filter(pairs, lambda t: F.contains(v, t["part"])), F.lit(0))["name"])


def first_term(text: Column, terms: Sequence[str]) -> Column:
    """The first of the terms, in their order, that occurs, capitals aside; else null."""
    return first_of(F.lower(text_or_empty(text)), [(t, t.lower()) for t in terms])


def is_proper_token_subset(a: Column, b: Column) -> Column:
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    more, less = F.size(F.array_except(x, y)), F.size(F.array_except(y, x))
    return ((more == 0) | (less == 0)) & (more + less > 0)


def strip_place_tokens(name: Column, place: Column) -> Column:
    """name without the tokens of place (both normalised); the whole name if none is left."""
    taken = F.split(place, " ")
    rest = F.array_join(F.filter(F.split(name, " "), lambda t: ~F.array_contains(taken, t)), " ")
    return F.coalesce(F.nullif(rest, F.lit("")), name)
