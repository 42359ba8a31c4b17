"""References in pages, resolved against the page's address.  Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, text_or_empty

#: Named entities that are decoded, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def without_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def authority(url: Column) -> Column:
    """Between // and the next /, ? or #; '' if there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    """With its question mark; '' if there is none."""
    return F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)


def without_dots(segments: Column) -> Column:
    """A path of its segments: '.' goes, '..' takes the one before it along; a path that ends with either ends with a slash."""
    step = lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.array_append(kept, s))
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    ended = F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    joined = F.array_join(ended, "/")
    return F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))


def merged_path(base: Column, ref: Column) -> Column:
    """The path of a reference without host: as it is from the root, else in the folder of the base's path, empty segments inside dropped."""
    folder = F.split(F.regexp_replace(base, r"[^/]*$", ""), "/")  # its last segment is ''
    all_ = F.concat(F.slice(folder, F.lit(1), F.greatest(F.size(folder) - 1, F.lit(1))), F.split(ref, "/"))
    inner = F.filter(F.slice(all_, F.lit(2), F.greatest(F.size(all_) - 2, F.lit(0))), lambda s: s != "")
    relative = F.concat(F.slice(all_, F.lit(1), F.lit(1)), inner, F.slice(all_, F.size(all_), F.lit(1)))
    return without_dots(F.when(F.startswith(ref, F.lit("/")), F.split(ref, "/")).otherwise(relative))


def resolved(base: Column, ref: Column) -> Column:
    """The absolute address of a reference on the page ``base``, without fragment (RFC 3986).  One with a host, or of another scheme, stays as written."""
    clean = F.regexp_replace(F.regexp_replace(F.btrim(F.regexp_replace(text_or_empty(ref), r"[\t\r\n]", "")), r"#.*$", ""), r"^(?i)([a-z][a-z0-9+.-]*):(?=[^/]|/(?!/)|$)", "$1\u0000")

    def of(r: Column) -> Column:
        # a scheme without // is marked by a zero: the base's own counts for nothing, another one ends the search
        bare = F.regexp_extract(r, "^([^\u0000]*)\u0000", 1)
        own = F.when((bare != "") & (F.lower(bare) == scheme(base)), F.regexp_extract(r, "\u0000(.*)$", 1)).otherwise(r)
        return bound(own, placed)

    def placed(r: Column) -> Column:
        site = F.concat(scheme(base), F.lit("://"), authority(base))
        there = F.when(path(r) != "", F.concat(merged_path(path(base), path(r)), query(r))).when(query(r) != "", F.concat(path(base), query(r))).otherwise(F.concat(path(base), query(base)))
        return (
            F.when(F.contains(r, F.lit("\u0000")), F.replace(r, F.lit("\u0000"), F.lit(":")))
            .when(scheme(r) != "", F.concat(scheme(r), F.substring(r, F.length(scheme(r)) + 1, F.length(r))))
            .when(F.startswith(r, F.lit("//")), F.concat(scheme(base), F.lit(":"), r))
            .otherwise(F.concat(site, there))
        )

    return bound(clean, of)


#: What stands in a tag: > may stand in a quoted value.
_INSIDE = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
_ATTRIBUTE = r"""([^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)"""
_HREF = r"""(?is)^href\s*=\s*(?:"([^"]*)"|'([^']*)'|(.*))$"""


def anchors(html: Column) -> Column:
    """href and label (text without tags, trimmed, lower-cased) of the links of a page in their order.

    Comments, scripts and styles have none.  Values may stand in either quotes or none; a link ends at its closing tag, at the next link or with the
    page.
    """
    seen = F.regexp_replace(text_or_empty(html), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    tags = F.regexp_extract_all(seen, F.lit(rf"(?is)(<a(?=[\s/]){_INSIDE}>.*?)(?=</a\b|<a[\s>/]|\z)"), 1)

    def link(a: Column) -> Column:
        head = F.regexp_extract(a, rf"(?is)^<a({_INSIDE})>", 1)
        named = F.filter(F.regexp_extract_all(head, F.lit(_ATTRIBUTE), 1), lambda x: F.rlike(x, F.lit(r"(?i)^href\s*=")))
        href = text_or_empty(bound(F.get(named, F.lit(0)), lambda x: F.concat(*[F.regexp_extract(x, _HREF, i) for i in (1, 2, 3)])))
        label = F.regexp_replace(F.substring(a, F.length(head) + 4, F.length(a)), r"(?is)<[^>]*>", "")
        return F.struct(without_entities(href).alias("href"), F.lower(F.btrim(without_entities(label), F.lit(" \t\r\n\f "))).alias("label"))

    return F.filter(F.transform(tags, link), lambda x: x["href"] != "")
