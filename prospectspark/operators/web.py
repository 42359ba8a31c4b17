"""Stored web pages: status, technology, rating, links, text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text, urls
from ..sources.io import written
from .keyed import even_spread_sample, first_by_key, upsert

c = F.col
L = config.EVIDENCE
#: Where a generator names its version, and the first version that counts as modern.
CMS = {"wordpress": (r"wordpress[ /]*(\d+)", 6), "typo3": (r"typo3[^0-9]{0,8}(\d+)", 11), "joomla": (r"joomla!?[^0-9]{0,8}(\d+)", 4)}


def page_status(error: Column, body: Column) -> Column:
    return F.when(error == "robots", "skipped_robots").when(text.text_or_empty(error) != "", "error").when(text.collapse(text.text_or_empty(body)) != "", "extracted_text").otherwise("fetched")


def meta(html: Column, name: str) -> Column:
    """The whole meta tag of that name, or ''."""
    return F.regexp_extract(text.text_or_empty(html), rf"(?is)<meta[^>]*\bname=[\"']?{name}[\"'\s>][^>]*>?", 0)


def generator(html: Column) -> Column:
    found = lambda pattern: F.nullif(F.regexp_extract(meta(html, "generator"), pattern, 1), F.lit(""))
    return F.coalesce(found(r"(?is)\bcontent\s*=\s*[\"']([^\"']*)"), found(r"(?is)\bcontent\s*=\s*([^\s\"'>]+)"))


def tech_signals(pages: DataFrame, most: int = 200_000) -> DataFrame:
    """pages (url, html, http_version, headers_json) with scheme, generator, viewport, lower-cased html and the headers' year."""
    modified = F.get_json_object("headers_json", "$.Last-Modified")
    return pages.select(
        "*", F.lower(F.regexp_extract("url", r"^([A-Za-z]+)://", 1)).alias("scheme"), generator(c("html")).alias("generator"), (meta(c("html"), "viewport") != "").alias("viewport"),
        F.lower(F.substring(text.text_or_empty(c("html")), 1, most)).alias("home_html"), text.year_in_text(modified).alias("last_modified_year"),
    )


def copyright_year(html: Column, now_year: int, tail: int = 3000) -> Column:
    """The year behind a copyright sign, else the latest plausible year near the end."""
    page = text.text_or_empty(html)
    signed = F.nullif(F.regexp_extract(page, r"(?i)(?:©|&copy;|copyright)\D{0,12}(20\d{2})", 1), F.lit("")).cast("int")
    years = F.transform(F.regexp_extract_all(F.substring(page, -tail, tail), F.lit(r"(20\d{2})")), lambda y: y.cast("int"))
    return F.coalesce(signed, F.array_max(F.filter(years, lambda y: y.between(2000, now_year + 1))))


def has_any(low: Column, marks: Sequence[str]) -> Column:
    """low is lower-cased already."""
    return F.exists(F.array(*[F.lit(m) for m in marks]), lambda m: F.contains(low, m))


def version(gen: Column, product: str) -> Column:
    return F.nullif(F.regexp_extract(gen, product, 1), F.lit("")).try_cast("decimal(38,0)")


def cms_rating(gen: Column, html: Column) -> Column:
    """struct of tier (modern, veraltet or unbekannt) and label, from the generator's version first, from traces in the page else.  Both lower-cased."""
    blob = F.concat(gen, F.lit(" "), html)
    rated = lambda tier, label: F.struct(F.lit(tier).alias("tier"), (F.lit(label) if isinstance(label, str) else label).alias("label"))
    named = lambda product, v, old: F.concat(F.lit(f"{product}_"), v.cast("string"), F.lit(L["old_version"] if old else ""))
    out = F.when(has_any(blob, config.PARKING), rated("veraltet", L["parked"]))
    traces = {"wordpress": has_any(gen, ("wordpress",)) | has_any(blob, ("wp-content", "/wp-json")), "typo3": has_any(gen, ("typo3",)), "joomla": has_any(gen, ("joomla",))}
    for product, (pattern, least) in CMS.items():
        v = version(gen, pattern)
        out = out.when(v >= least, rated("modern", named(product, v, False))).when(v.isNotNull(), rated("veraltet", named(product, v, True))).when(traces[product], rated("unbekannt", f"{product}_{L['no_version']}"))
    return (
        out.when(has_any(blob, config.STACK_EVERGREEN), rated("modern", L["evergreen"])).when(has_any(blob, config.STACK_OUTDATED), rated("veraltet", L["stack_outdated"]))
        .when(has_any(blob, config.STACK_MODERN), rated("modern", L["stack_modern"])).otherwise(rated("unbekannt", L["stack_unknown"]))
    )


def modernity_score(sites: DataFrame, now_year: int) -> DataFrame:
    """score (0 to 10, null if unreachable), its five components and the evidence for them, in a fixed order (null if unreachable).

    sites: reachable, scheme, tls_insecure, http_version, headers_json, home_html (lower-cased), generator, viewport, copyright_year, last_modified_year
    and, if known, http_to_https_redirect.
    """
    headers = F.transform(F.map_entries(F.from_json("headers_json", "map<string,string>")), lambda e: F.lower(F.concat(e["key"], F.lit(": "), e["value"])))
    blob = F.coalesce(F.array_join(headers, " "), F.lit(""))
    has_header = lambda name: F.coalesce(F.exists(headers, lambda h: F.startswith(h, F.lit(f"{name}:"))), F.lit(False))
    cms = c("__cms")
    newest = F.greatest(F.nullif("copyright_year", F.lit(0)), F.nullif("last_modified_year", F.lit(0)))
    points = lambda hit, n: F.when(F.coalesce(hit, F.lit(False)), float(n)).otherwise(0.0)
    insecure = F.coalesce(c("tls_insecure"), F.lit(False))
    secure = (c("scheme") == "https") & ~insecure
    hsts, modern_http = has_header("strict-transport-security"), F.rlike(text.text_or_empty(c("http_version")), F.lit("[23]"))
    shielded = has_any(blob, config.CDN_HEADERS) | has_header("content-security-policy")
    video, interactive = has_any(c("home_html"), config.VIDEO), has_any(c("home_html"), config.INTERACTIVE)
    old = newest <= now_year - 3
    recent = (newest >= now_year - 1) & ~old
    parts = {
        "transport": points(secure, 1.5) + points(hsts, 0.5) + points(modern_http, 1),
        "stack": F.when(cms["tier"] == "modern", 2.0).when(cms["tier"] == "unbekannt", 1.0).otherwise(0.0) + points(shielded, 1),
        "mobile": points(c("viewport"), 1),
        "media": points(video, 1) + points(interactive, 1),
        "upkeep": points(recent, 1),
    }
    redirect = F.coalesce(c("http_to_https_redirect"), F.lit(False)) if "http_to_https_redirect" in sites.columns else F.lit(False)
    said = F.array(
        F.when(secure, F.when(redirect, L["https_redirect"]).otherwise(L["https"])).when(insecure, L["tls_insecure"]).otherwise(L["http"]), F.when(hsts, L["hsts"]),
        F.when(modern_http, F.concat(F.lit(L["http_version"]), F.upper("http_version"))), cms["label"], F.when(shielded, L["cdn"]), F.when(c("viewport"), L["viewport"]), F.when(video, L["video"]),
        F.when(interactive, L["interactive"]), F.when(recent, L["recent"]).when(old, L["old"]),
    )
    reached = F.coalesce(c("reachable"), F.lit(False))
    rating = cms_rating(F.lower(text.text_or_empty(c("generator"))), text.text_or_empty(c("home_html")))
    rated = sites.withColumn("__cms", rating).select("*", cms["tier"].alias("tier"), *[v.alias(k) for k, v in parts.items()], F.when(reached, F.array_compact(said)).alias("evidence")).drop("__cms")
    total = F.least(F.lit(10.0), F.greatest(F.lit(0.0), sum((c(k) for k in parts), F.lit(0.0))))
    return rated.withColumn("score", F.when(reached, F.bround(total).cast("int")))


def page_links(pages: DataFrame) -> DataFrame:
    """page_id and links: the absolute http addresses that lead to the page's own site, with their labels, in order.  pages: page_id, url, html."""
    host = text.normalize_host(c("url"))
    whole = F.transform(urls.anchors(c("html")), lambda x: F.struct(urls.resolved(c("url"), x["href"]).alias("link"), x["label"].alias("label")))
    own = lambda x: F.startswith(x["link"], F.lit("http")) & (text.registrable(F.lower(urls.authority(x["link"]))).isin("", text.registrable(host)))
    return pages.select("page_id", F.filter(whole, own).alias("links"))


def classify_links(pages: DataFrame, page_types: dict[str, Sequence[str]]) -> DataFrame:
    """page_id, type, link: the first link of each page type, where a link gives at most one type: the first that is still free and fits.

    A word of the type must stand in the link's label or path.  A fold over a page's links in their order; the state is the map of types found so far.
    """
    kinds = {t: [w.lower() for w in words] for t, words in page_types.items() if t != "home" and words}
    empty = F.create_map().cast("map<string,string>")

    def step(found: Column, link: Column) -> Column:
        def taken(hay: Column) -> Column:
            return F.coalesce(*[F.when(~F.map_contains_key(found, F.lit(t)) & has_any(hay, words), t) for t, words in kinds.items()])

        kind = text.bound(F.concat(link["label"], F.lit(" "), F.lower(urls.path(link["link"]))), taken)
        return text.bound(kind, lambda k: F.when(k.isNull(), found).otherwise(F.map_concat(found, F.map_from_arrays(F.array(F.coalesce(k, F.lit(""))), F.array(link["link"])))))

    return page_links(pages).select("page_id", F.explode(F.aggregate("links", empty, step)).alias("type", "link"))


def select_pages(links: DataFrame, priority: Sequence[str], limit: int) -> DataFrame:
    """page_id, place, type, link: home first, then by priority up to the limit.

    links: page_id, type, link and home (the page's own url); type is null for a page without links.
    """
    order = F.array(*[F.lit(t) for t in priority if t != "home"])
    kinds = links.groupBy("page_id").agg(F.first("home").alias("home"), F.map_from_entries(F.collect_list(F.when(c("type").isNotNull(), F.struct("type", "link")))).alias("found"))
    chosen = F.filter(order, lambda t: F.map_contains_key(c("found"), t))
    pages = F.slice(F.concat(F.array(F.struct(F.lit("home").alias("type"), c("home").alias("link"))), F.transform(chosen, lambda t: F.struct(t.alias("type"), F.try_element_at(c("found"), t).alias("link")))), 1, limit)
    return kinds.select("page_id", F.posexplode(pages).alias("place", "p")).select("page_id", "place", "p.type", "p.link")


#: How deep navigation and footers may be nested.
NESTED = 4


def without_element(html: Column, tag: str) -> Column:
    """html without the elements of that name, the innermost first, so that what is nested goes with what holds it."""
    for _ in range(NESTED):
        html = F.regexp_replace(html, rf"(?is)<{tag}\b[^>]*+>[^<]*+(?:<(?!/?{tag}\b)[^<]*+)*+</{tag}\s*>", " ")
    return html


def main_text(html: Column) -> Column:
    """Visible text: without scripts, styles, navigation, footers (nested ones too), comments and tags; common entities decoded."""
    out = F.regexp_replace(text.text_or_empty(html), r"(?is)<!--.*?-->", " ")
    for tag in ("script", "style"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    for tag in ("nav", "footer"):
        out = without_element(out, tag)
    out = F.regexp_replace(out, r"(?is)<head\b.*?</head\s*>", " ")
    out = F.regexp_replace(out, r"(?is)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return text.collapse(out)


def page_rows(pages: DataFrame, wave: int, now: str) -> DataFrame:
    """Crawled pages as stored rows; those without url are left out.  The protocol, headers, generator and features are those of a reachable home page.

    pages: company_id, url, page_type, error, http_status, text_content, reachable, and of tech_signals http_version, headers_json, generator, scheme,
    http_to_https_redirect, viewport, copyright_year, last_modified_year.
    """
    home = (c("page_type") == "home") & F.coalesce(c("reachable"), F.lit(False))
    features = F.to_json(F.struct("scheme", "http_to_https_redirect", "viewport", "copyright_year", "last_modified_year", "generator"))
    return pages.filter(text.text_or_empty(c("url")) != "").select(
        "company_id", "url", "page_type", page_status(c("error"), c("text_content")).alias("fetch_status"), "http_status", F.nullif("text_content", F.lit("")).alias("text_content"), c("error").alias("error_reason"),
        F.lit(wave).alias("crawl_wave"), F.lit(now).cast("timestamp").alias("fetched_at"), F.when(home, c("http_version")).alias("http_protocol"), F.when(home, c("headers_json")).alias("response_headers"),
        F.when(home, c("generator")).alias("generator_tag"), F.when(home, features).alias("tech_features"),
    )


def persist_pages(existing: DataFrame, pages: DataFrame, order: str, wave: int, now: str) -> DataFrame:
    """existing with the first page of each company and url written over it, as of page_rows."""
    firsts = first_by_key(pages.filter(text.text_or_empty(c("url")) != ""), ["company_id", "url"], [order])
    return upsert(existing, page_rows(firsts, wave, now), ["company_id", "url"])


def flag_no_text(companies: DataFrame, pages: DataFrame) -> DataFrame:
    """company_id, state: reachable companies of which no page has text, flagged already or to flag.  companies: id, reachable, no_text_content."""
    with_text = pages.filter(text.collapse(text.text_or_empty(c("text_content"))) != "").select(c("company_id").alias("id")).distinct()
    bare = companies.filter(F.coalesce(c("reachable"), F.lit(False))).join(with_text, "id", "left_anti")
    return bare.select(c("id").alias("company_id"), F.when(F.coalesce(c("no_text_content"), F.lit(False)), "flagged").otherwise("to flag").alias("state"))


def error_label(message: Column) -> Column:
    low = F.lower(text.text_or_empty(message))
    return (
        F.when(has_any(low, ("certificate",)), "tls_certificate").when(has_any(low, ("dh_key_too_small", "ssl", "tlsv1")), "tls").when(has_any(low, ("streamreset", "remoteprotocol", "protocolerror")), "http2")
        .when(has_any(low, ("timeout", "timed out")), "timeout").when(has_any(low, ("getaddrinfo", "name or service", "nodename")), "dns").when(has_any(low, ("connect",)), "connect").otherwise("unreachable")
    )


def crawl_report(sites: DataFrame) -> DataFrame:
    """One row over companies (reachable, n_pages, key_page: has an about or team page, score: null where unreachable)."""
    reached = c("reachable")
    return sites.agg(
        F.count("*").alias("n"), F.count_if(reached).alias("reachable"), F.sum(F.when(reached, c("n_pages"))).alias("pages"), F.count_if(reached & (c("n_pages") >= 3)).alias("three_pages"), F.count_if(reached & c("key_page")).alias("about_or_team"), F.count_if(reached & c("score").isNull()).alias("without_score"),
        F.round(F.avg("score"), 6).alias("score_mean"), F.percentile("score", 0.5).alias("score_median"),
    )


def crawl_sample(sites: DataFrame, k: int = 10) -> DataFrame:
    """Reachable sites with a score at even distances of their order by score; all if there are no more than k.  sites: company_id, reachable, score."""
    rated = written(sites.filter(c("reachable") & c("score").isNotNull()), "rated")
    return even_spread_sample(rated, ["score", "company_id"], k)


def crawl_counts(sites: DataFrame, page_errors: DataFrame) -> DataFrame:
    """kind, value, n: reachable companies by number of pages and by score, unreachable ones by error, failed pages of reachable ones by error.

    sites: company_id, reachable, n_pages, score, error (label); page_errors: company_id, error (label), one row for each failed page.
    """
    reached, shown = c("reachable"), lambda col: col.cast("string")
    entry = lambda kind, hit, value: F.when(hit, F.struct(F.lit(kind).alias("kind"), value.alias("value")))
    entries = F.array(
        entry("pages", reached, shown(c("n_pages"))), entry("score", reached & c("score").isNotNull(), shown(c("score"))), entry("error", ~reached, F.coalesce(F.nullif("error", F.lit("")), F.lit("unbekannt")))
    )
    rows = sites.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("x")).select("x.*")
    of_pages = page_errors.join(sites.filter(reached).select("company_id"), "company_id", "left_semi").select(F.lit("page_error").alias("kind"), c("error").alias("value"))
    return rows.unionByName(of_pages).groupBy("kind", "value").agg(F.count("*").alias("n"))
