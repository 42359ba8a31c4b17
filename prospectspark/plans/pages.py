"""Queries on web pages (F) and evidence (G)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..operators import evidence, web
from ..sources.fixtures import fixture, table
from .common import Registry, sql_list
from .scores import CRAWL, SCORES, VIEWS, crawled, scores

R = Registry()
c = F.col
YEAR = 2024
CONTEXT_CHARS = 40_000
PAGE_TYPES = {"historie": ("geschichte", "historie"), "about": ("ueber-uns", "unternehmen", "firma"), "karriere": ("karriere", "jobs"), "news": ("news", "the"), "produkte": ("to", "and")}
PRIORITY = ("about", "historie", "team", "karriere", "produkte", "home", "referenzen", "impressum", "news")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_pages")


def has(low: str, marks) -> str:
    return f"(len(list_filter({sql_list(marks)}, lambda q: contains({low}, q))) > 0)"


_TEXT = "html"
for _pattern in ["<!--.*?-->", *[rf"<{t}\b.*?</{t}\s*>" for t in ("script", "style", "nav", "footer", "head")], "<[^>]*>"]:
    _TEXT = f"regexp_replace({_TEXT}, '{_pattern}', ' ', 'gis')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
    _TEXT = f"replace({_TEXT}, '{_entity}', '{_char}')"
MAIN_TEXT = rf"trim(regexp_replace(replace({_TEXT}, chr(160), ' '), '\s+', ' ', 'g'))"
_BODY = f"case when page_id % 6 = 0 then ' ' when page_id % 10 = 0 then null else {MAIN_TEXT} end"


def with_body(df: DataFrame) -> DataFrame:
    """Some pages have no text, the others their main text."""
    return df.withColumn("text_content", F.when(c("page_id") % 6 == 0, " ").when(c("page_id") % 10 != 0, web.main_text(c("html"))))


STATUS = f"case when error = 'robots' then 'skipped_robots' when coalesce(error, '') <> '' then 'error' when trim(coalesce({_BODY}, '')) <> '' then 'extracted_text' else 'fetched' end"


@R.add("f1_page_status", f"select page_id, {STATUS} as status from v_pages", ("v_pages",))
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_body(pages(spark, sf_dir)).select("page_id", web.page_status(c("error"), c("text_content")).alias("status"))


TECH = r"""tech as (select *, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) as scheme, nullif(regexp_extract(regexp_extract(html, '<meta[^>]*\bname="generator"[^>]*>', 0, 'is'), '\bcontent="([^"]*)', 1, 'is'), '') as generator,
  regexp_extract(html, '<meta[^>]*\bname="viewport"[^>]*>', 0, 'is') <> '' as viewport, lower(substr(html, 1, 200000)) as home_html from v_pages)"""


@R.add("f2_tech_signals", f"with {TECH} select page_id, scheme, generator, viewport, length(home_html) as html_length from tech", ("v_pages",))
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.tech_signals(pages(spark, sf_dir)).select("page_id", "scheme", "generator", "viewport", F.length("home_html").cast("long").alias("html_length"))


COPYRIGHT = r"""coalesce(try_cast(nullif(regexp_extract(html, '(?:©|&copy;|copyright)\D{0,12}(20\d{2})', 1, 'i'), '') as int),
  list_max(list_filter(list_transform(regexp_extract_all(right(html, 3000), '(20\d{2})'), lambda y: cast(y as int)), lambda y: y between 2000 and 2025)))"""


@R.add("f3_copyright_year", f"select page_id, {COPYRIGHT} as year from v_pages", ("v_pages",))
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", web.copyright_year(c("html"), YEAR).alias("year"))


_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
_HITS = ", ".join(f"case when {has('hay', [w.lower() for w in words])} then '{t}' end" for t, words in PAGE_TYPES.items() if t != "home" and words)
_HOST = lambda u: f"regexp_replace(lower(regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\\.', '')"
_PLAIN = lambda c_: f"replace(replace({c_}, '&nbsp;', chr(160)), '&amp;', '&')"
# pieces of a page from one link to the next; references resolved segment by segment; then a fold over each page's links, one link a round
LINKS = rf"""raw as (select page_id, url, unnest(t[2:]) as a, unnest(range(1, len(t))) as k from (select page_id, url, string_split_regex(regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis'), '(?i)<a[\s/]') as t from v_pages)),
 hd as (select *, regexp_extract(a, '^((?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 1) as h from raw),
 ax as (select *, list_filter(regexp_extract_all(h, '[^\s=>"''/]+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s>"'']+))?'), lambda x: regexp_matches(x, '^href\s*=', 'i'))[1] as x,
   regexp_extract(substr(a, length(h) + 2), '^(.*?)(?:</a\b|$)', 1, 'is') as inner_ from hd),
 rf as (select page_id, url, k, regexp_replace(trim({_PLAIN("regexp_replace(regexp_replace(x, '^href\\s*=\\s*[\"'']?', '', 'i'), '[\"'']$', '')")}), '#.*$', '') as ref,
   lower(trim({_PLAIN("regexp_replace(inner_, '<[^>]*>', '', 'g')")}, chr(9) || chr(10) || chr(13) || chr(160) || ' ')) as label,
   lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || regexp_extract(url, '//([^/?#]*)', 1) as site, regexp_extract(url, '//[^/?#]*([^?#]*)', 1) as bp, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) as bq
   from ax where regexp_replace(regexp_replace(x, '^href\s*=\s*["'']?', '', 'i'), '[\"'']$', '') <> ''),
 sg as (select *, regexp_extract(ref, '^([^?#]*)', 1) as rp, regexp_extract(ref, '^[^?#]*(\?.*)', 1) as rq, string_split(regexp_replace(bp, '[^/]*$', ''), '/') as f from rf),
 al as (select *, list_concat(f[1 : greatest(len(f) - 1, 1)], string_split(rp, '/')) as l from sg),
 ms as (select *, case when starts_with(rp, '/') then string_split(rp, '/') else list_concat(l[1:1], list_filter(l[2 : len(l) - 1], lambda s: s <> ''), l[len(l) : len(l)]) end as m from al),
 dt as (select *, list_reduce(list_prepend([]::varchar[], list_transform(m, lambda s: [s])), lambda p, s: case when s[1] = '..' then p[1 : len(p) - 1] when s[1] = '.' then p else list_concat(p, s) end) as d from ms),
 pt as (select *, array_to_string(case when m[len(m)] in ('.', '..') then list_append(d, '') else d end, '/') as j from dt),
 fu as (select page_id, url, k, label, case when regexp_matches(ref, '{_SCHEME}') then ref when starts_with(ref, '//') then split_part(site, '//', 1) || ref
   when rp <> '' then site || case when starts_with(j, '/') then '' else '/' end || j || rq when rq <> '' then site || bp || rq else site || bp || bq end as link from pt),
 ow as (select page_id, link, row_number() over (partition by page_id order by k) as n, label || ' ' || lower(regexp_extract(link, '//[^/?#]*([^?#]*)', 1)) as hay from fu where starts_with(link, 'http') and {_HOST('link')} in ('', {_HOST('url')})),
 ht as (select *, list_filter([{_HITS}], lambda t: t is not null) as hits from ow),
 fold as (with recursive g as (select page_id, 0 as n, []::varchar[] as done, null::varchar as type, null::varchar as link from v_pages
   union all select ht.page_id, ht.n, case when list_filter(hits, lambda t: not list_contains(done, t))[1] is null then done else list_append(done, list_filter(hits, lambda t: not list_contains(done, t))[1]) end,
   list_filter(hits, lambda t: not list_contains(done, t))[1], ht.link from g join ht on ht.page_id = g.page_id and ht.n = g.n + 1) select page_id, type, link from g where type is not null)"""


@R.add("f4_classify_links", f"with {LINKS} select page_id, type, link from fold", ("v_pages",))
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.classify_links(pages(spark, sf_dir), PAGE_TYPES)


@R.add(
    "f5_select_pages",
    f"""with {LINKS}, r as (select page_id, type, link, row_number() over (partition by page_id order by list_position({sql_list(PRIORITY)}, type)) as place from fold where list_contains({sql_list(t for t in PRIORITY if t != 'home')}, type))
    select page_id, cast(place as int) as place, type, link from r where place < 4 union all select page_id, 0, 'home', url from v_pages""",
    ("v_pages",),
)
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = pages(spark, sf_dir)
    links = df.select("page_id", c("url").alias("home")).join(web.classify_links(df, PAGE_TYPES), "page_id", "left")
    return web.select_pages(links, PRIORITY, 4)


@R.add("f6_main_text", f"select page_id, {MAIN_TEXT} as body from v_pages", ("v_pages",))
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", web.main_text(c("html")).alias("body"))


def _version(pattern: str) -> str:
    return f"try_cast(nullif(regexp_extract(gen, '{pattern}', 1), '') as int)"


TIER = f"""case when {has('blob', config.PARKING)} then 'veraltet' when wp is not null then case when wp >= 6 then 'modern' else 'veraltet' end
 when contains(gen, 'wordpress') or {has('blob', ('wp-content', '/wp-json'))} then 'unbekannt' when t3 is not null then case when t3 >= 11 then 'modern' else 'veraltet' end when contains(gen, 'typo3') then 'unbekannt'
 when jo is not null then case when jo >= 4 then 'modern' else 'veraltet' end when contains(gen, 'joomla') then 'unbekannt' when {has('blob', config.STACK_EVERGREEN)} then 'modern'
 when {has('blob', config.STACK_OUTDATED)} then 'veraltet' when {has('blob', config.STACK_MODERN)} then 'modern' else 'unbekannt' end"""
RATED = rf"""{TECH}, v as (select *, lower(coalesce(generator, '')) as gen, lower(coalesce(generator, '')) || ' ' || home_html as blob, {COPYRIGHT} as cy, lower(headers_json) as hj from tech),
 w as (select *, {_version('wordpress[ /]*(\\d+)')} as wp, {_version('typo3[^0-9]{0,8}(\\d+)')} as t3, {_version('joomla!?[^0-9]{0,8}(\\d+)')} as jo from v), r as (select *, {TIER} as tier from w),
 p as (select *, case when scheme = 'https' then 1.5 else 0 end + case when contains(hj, 'strict-transport-security') then 0.5 else 0 end + case when regexp_matches(http_version, '[23]') then 1 else 0 end as transport,
  case tier when 'modern' then 2 when 'unbekannt' then 1 else 0 end + case when contains(hj, 'cloudflare') then 1 else 0 end as stack, viewport::int as mobile,
  {has('home_html', config.VIDEO)}::int + {has('home_html', config.INTERACTIVE)}::int as media, coalesce(cy >= 2023, false)::int as upkeep from r),
 rated as (select *, case when coalesce(error, '') = '' then cast(round_even(least(10, transport + stack + mobile + media + upkeep), 0) as int) end as score from p)"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as the home page of a site."""
    df = web.tech_signals(pages(spark, sf_dir)).withColumn("copyright_year", web.copyright_year(c("html"), YEAR)).withColumn("tls_insecure", F.lit(False))
    return df.withColumn("reachable", text.text_or_empty(c("error")) == "")


_LABEL = f"""case when {has('blob', config.PARKING)} then 'geparkt' when wp is not null then 'wordpress_' || wp || case when wp >= 6 then '' else '_alt' end when contains(gen, 'wordpress') or {has('blob', ('wp-content', '/wp-json'))} then 'wordpress_ohne_version'
 when t3 is not null then 'typo3_' || t3 || case when t3 >= 11 then '' else '_alt' end when contains(gen, 'typo3') then 'typo3_ohne_version' when jo is not null then 'joomla_' || jo || case when jo >= 4 then '' else '_alt' end
 when contains(gen, 'joomla') then 'joomla_ohne_version' when {has('blob', config.STACK_EVERGREEN)} then 'evergreen_saas' when {has('blob', config.STACK_OUTDATED)} then 'stack_veraltet' when {has('blob', config.STACK_MODERN)} then 'stack_modern' else 'stack_unbekannt' end"""
_SAID = f"""case when coalesce(error, '') = '' then array_to_string(list_filter([case when scheme = 'https' then 'https' else 'nur_http' end, case when contains(hj, 'strict-transport-security') then 'hsts' end, case when regexp_matches(http_version, '[23]') then 'http_version:' || upper(http_version) end,
 {_LABEL}, case when contains(hj, 'cloudflare') then 'cdn_oder_csp' end, case when viewport then 'viewport' end, case when {has('home_html', config.VIDEO)} then 'video' end, case when {has('home_html', config.INTERACTIVE)} then 'interaktiv' end,
 case when cy >= 2023 then 'aktuell' when cy <= 2021 then 'veraltet' end], lambda x: x is not null), '; ') end"""


@R.add("f7_modernity_score", f"with {RATED} select page_id, score, transport::double as transport, stack::double as stack, mobile::double as mobile, media::double as media, upkeep::double as upkeep, {_SAID} as evidence from rated", ("v_pages",))
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = web.modernity_score(sites(spark, sf_dir), YEAR)
    return rated.select("page_id", "score", "transport", "stack", "mobile", "media", "upkeep", F.array_join("evidence", "; ").alias("evidence"))


@R.add("f8_cms_tier", f"with {RATED} select page_id, tier from rated", ("v_pages",))
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.modernity_score(sites(spark, sf_dir), YEAR).select("page_id", "tier")


@R.add(
    "f9_persist_pages",
    f"""with {TECH}, b as (select *, case when page_id % 19 = 0 then '' else 'u' || (page_id % 5) end as u, {STATUS} as fetch_status, {_BODY} as body, {COPYRIGHT} as cy, page_type = 'home' and coalesce(error, '') = '' as home from tech),
    f as (select * from (select *, row_number() over (partition by company_id, u order by page_id) as k from b where u <> '') where k = 1),
    e as (select distinct company_id, 'u' || (page_id % 9) as url from v_pages)
    select company_id, u as url, page_type, fetch_status, cast(200 + page_id % 3 as int) as http_status, nullif(body, '') as text_content, error as error_reason, cast(2 as int) as crawl_wave, timestamp '2024-01-02' as fetched_at, case when home then http_version end as http_protocol,
      case when home then headers_json end as response_headers, case when home then generator end as generator_tag,
      case when home then '{{"scheme":"' || scheme || '","viewport":' || viewport || case when cy is null then '' else ',"copyright_year":' || cy end || case when generator is null then '' else ',"generator":"' || generator || '"' end || '}}' end as tech_features from f
    union all select company_id, url, 'old', 'fetched', null, null, null, null, null, null, null, null, null from e where not exists (select 1 from f where f.company_id is not distinct from e.company_id and f.u = e.url)""",
    ("v_pages",),
)
def f9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored side has pages of all companies, some of them under urls that come again; some new pages have no url."""
    df = with_body(sites(spark, sf_dir)).withColumn("http_status", (F.lit(200) + c("page_id") % 3).cast("int")).withColumn("http_to_https_redirect", F.lit(None).cast("boolean"))
    url = lambda n: F.concat(F.lit("u"), (c("page_id") % n).cast("string"))
    existing = df.select("company_id", url(9).alias("url")).distinct().select("*", F.lit("old").alias("page_type"), F.lit("fetched").alias("fetch_status"), F.lit(None).cast("string").alias("text_content"))
    return web.persist_pages(existing, df.withColumn("url", F.when(c("page_id") % 19 == 0, "").otherwise(url(5))), "page_id", 2, "2024-01-02")


@R.add(
    "f10_flag_no_text",
    f"""with t as (select distinct company_id from v_pages where trim(coalesce({_BODY}, '')) <> '')
    select id as company_id, case when id % 7 = 0 then 'flagged' else 'to flag' end as state from v_companies where id % 3 <> 0 and not exists (select 1 from t where company_id = id)""",
    ("v_pages", "v_companies"),
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = fixture(spark, sf_dir, "v_companies").select("id", (c("id") % 3 != 0).alias("reachable"), (c("id") % 7 == 0).alias("no_text_content"))
    return web.flag_no_text(firms, with_body(pages(spark, sf_dir)))


for _name in ("f9_persist_pages", "f10_flag_no_text"):  # second names of queries that once took a part of the pages
    R.alias(f"{_name}_all", _name)


_ERRORS = ("SSL: CERTIFICATE_VERIFY_FAILED", "tlsv1 alert", "StreamReset by peer", "ReadTimeout", "[Errno] getaddrinfo failed", "ConnectError", "", "odd")
_LABELS = ("tls_certificate", "tls", "http2", "timeout", "dns", "connect", "unreachable", "unreachable")


@R.add("f12_error_label", f"select page_id, {sql_list(_LABELS)}[page_id % 8 + 1] as label from v_pages", ("v_pages",))
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.get(F.array(*map(F.lit, _ERRORS)), (c("page_id") % 8).cast("int"))
    return pages(spark, sf_dir).select("page_id", web.error_label(message).alias("label"))


@R.add(
    "f13_crawl_report",
    f"""with {RATED}, s as (select company_id, bool_or(coalesce(error, '') = '') as reachable, count(*) as n_pages, bool_or(page_type in ('about', 'team')) as key_page, max(score) as score from rated group by 1)
    select count(*) as n, count(*) filter (reachable) as reachable, cast(sum(n_pages) filter (reachable) as bigint) as pages, count(*) filter (reachable and n_pages >= 3) as three_pages, count(*) filter (reachable and key_page) as about_or_team, count(*) filter (reachable and score is null) as without_score, round(avg(score), 6) as score_mean,
      cast(median(score) as double) as score_median from s""",
    ("v_pages",),
)
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = web.modernity_score(sites(spark, sf_dir), YEAR)
    return web.crawl_report(
        rated.groupBy("company_id").agg(F.bool_or("reachable").alias("reachable"), F.count("*").alias("n_pages"), F.bool_or(c("page_type").isin("about", "team")).alias("key_page"), F.max("score").alias("score"))
    )


@R.add(
    "f13_crawl_sample",
    f"""with {RATED}, k as (select page_id, score, row_number() over (order by score, page_id) - 1 as p, count(*) over () as m from rated where score is not null)
    select page_id, score from k where m <= 10 or p in (select cast(round_even(j * (m - 1) / 9.0, 0) as bigint) from range(10) t(j))""",
    ("v_pages",),
)
def f13_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = web.modernity_score(sites(spark, sf_dir), YEAR)
    return web.crawl_sample(rated.select(c("page_id").alias("company_id"), "reachable", "score")).select(c("company_id").alias("page_id"), "score")


_SITE = "cast(floor(page_id / 8) as bigint)"


@R.add(
    "f13_crawl_counts",
    f"""with {RATED}, l as (select *, {_SITE} as site, {sql_list(_LABELS)}[page_id % 8 + 1] as label, floor(page_id / 8) % 10 = 0 or coalesce(error, '') <> '' as failed from rated),
    s as (select site, bool_or(not failed) as reachable, count(*) as n_pages, max(score) filter (not failed) as score, arg_min(label, page_id) as label from l group by 1)
    select 'pages' as kind, cast(n_pages as varchar) as value, count(*) as n from s where reachable group by 2 union all select 'score', cast(score as varchar), count(*) from s where reachable and score is not null group by 2
    union all select 'error', label, count(*) from s where not reachable group by 2 union all select 'page_error', l.label, count(*) from l join s using (site) where failed and reachable group by 2""",
    ("v_pages",),
)
def f13_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages dealt over sites, some of which answer nothing."""
    rated = web.modernity_score(sites(spark, sf_dir), YEAR)
    message = F.get(F.array(*map(F.lit, _ERRORS)), (c("page_id") % 8).cast("int"))
    rated = rated.select(F.floor(c("page_id") / 8).alias("company_id"), "page_id", "score", web.error_label(message).alias("error"), ((F.floor(c("page_id") / 8) % 10 == 0) | ~c("reachable")).alias("failed"))
    per = rated.groupBy("company_id").agg(F.bool_or(~c("failed")).alias("reachable"), F.count("*").alias("n_pages"), F.max(F.when(~c("failed"), c("score"))).alias("score"), F.min_by("error", "page_id").alias("error"))
    return web.crawl_counts(per, rated.filter("failed").select("company_id", "error"))


@R.add(
    "g1_extract_candidates",
    f"""with {CRAWL} select id, case when coalesce(round_even(prioritaets_score, 0), 2) <= 1 then 'low' else 'high' end as tier from crawl
    where website is not null and holding_reason is null and id % 5 in (1, 3) and id % 3 <> 1 and id not in (select company_id from v_dossiers where company_id % 2 = 0)""",
    ("v_dossiers", "v_companies"),
)
def g1(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = crawled(spark, sf_dir)
    texts = firms.filter("id % 3 <> 1").select(c("id").alias("company_id"))
    return evidence.extract_candidates(firms, fixture(spark, sf_dir, "v_dossiers").filter("company_id % 2 = 0"), texts).select("id", "tier")


_HEAD = "'" + re.sub(r"\{(\w+)\}", r"' || coalesce(cast(\1 as varchar), '') || '", config.CONTEXT_HEAD.replace("{gegenstand}", config.CONTEXT_NONE)).replace("\n", "' || chr(10) || '") + "'"
_BLOCK = "'" + re.sub(r"\{(\w+)\}", r"' || \1 || '", config.CONTEXT_BLOCK).replace("\n", "' || chr(10) || '") + "'"
CONTEXT = rf"""h as (select id as company_id, {_HEAD} as head from v_companies),
 b as (select cast(floor(doc_id / 7) as bigint) as company_id, doc_id as page_id, list_position({sql_list(PRIORITY)}, page_type) as rank, {_BLOCK} as b from (select doc_id, 'https://x.example/' || doc_id as url, regexp_replace(text, '^\s+|\s+$', '', 'g') as text,
  {sql_list(('home', 'about', 'historie', 'team', 'karriere', 'produkte', 'referenzen', 'news', 'impressum'))}[doc_id % 9 + 1] as page_type from documents) where trim(regexp_replace(replace(text, chr(160), ' '), '\s+', ' ', 'g')) <> ''),
 s as (select *, length(head) + coalesce(sum(length(b)) over (partition by company_id order by rank, page_id rows between unbounded preceding and 1 preceding), 0) as before from b join h using (company_id)),
 g as (select company_id, string_agg(substr(b, 1, cast({CONTEXT_CHARS} - before as int)), '' order by rank, page_id) as body from s where before < {CONTEXT_CHARS} group by 1)"""


@R.add("g2_assemble_context", f"with {CONTEXT} select company_id, head || coalesce(body, '') as context from h left join g using (company_id)", ("v_companies",))
def g2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ("home", "about", "historie", "team", "karriere", "produkte", "referenzen", "news", "impressum")))
    docs = table(spark, sf_dir, "documents").select(
        F.floor(c("doc_id") / 7).alias("company_id"), c("doc_id").alias("page_id"), F.get(kinds, (c("doc_id") % 9).cast("int")).alias("page_type"),
        F.concat(F.lit("https://x.example/"), c("doc_id").cast("string")).alias("url"), c("text").alias("text_content"),
    )
    return evidence.assemble_context(docs, fixture(spark, sf_dir, "v_companies"), PRIORITY, CONTEXT_CHARS)


def dossiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.parse_dossiers(fixture(spark, sf_dir, "v_dossiers"))


_B = lambda path: f"case json_extract_string(dossier_json, '$.{path}') when 'true' then true when 'false' then false when 'no' then false end"
_N = lambda path: f"cast(coalesce(json_array_length(dossier_json, '$.{path}'), 0) as int)"
_T = lambda field: f"json_extract_string(dossier_json, '$.{field}')"
_TEXT_FIELDS = ("kundentyp", "naechste_generation", "digitalisierung", "besonderheiten", "tonalitaet_website", "konfidenz")
_LIST_FIELDS = ("produkte_leistungen", "nachfolge_signale", "ansprache_hooks", "belege")


@R.add(
    "g3_parse_dossier",
    f"""select company_id, json_extract_string(dossier_json, '$.geschaeftsmodell') as model, {_B('familienunternehmen.hinweis')} as family, json_extract_string(dossier_json, '$.familienunternehmen.generation') as generation,
      {_B('fuehrungsstruktur.zweite_ebene_sichtbar')} as second_level, cast(json_array_length(dossier_json, '$.karriere.offene_stellen') as int) as jobs,
      try_cast({_T('gruendungsjahr')} as int) as founded, coalesce({_B('negativ_filter.insolvenz_hinweis')}, false) as insolvent, {_N('produkte_leistungen')} as products, {_N('nachfolge_signale')} as signs, {_N('belege')} as quotes,
      {_T('naechste_generation')} as next_generation, {_T('konfidenz')} as confidence, cast(null as varchar) as error from v_dossiers""",
    ("v_dossiers",),
)
def g3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dossiers(spark, sf_dir).select(
        "company_id", c("d.geschaeftsmodell").alias("model"), c("d.familienunternehmen.hinweis").alias("family"), c("d.familienunternehmen.generation").alias("generation"),
        c("d.fuehrungsstruktur.zweite_ebene_sichtbar").alias("second_level"), F.size("d.karriere.offene_stellen").alias("jobs"),
        c("d.gruendungsjahr").alias("founded"), c("d.negativ_filter.insolvenz_hinweis").alias("insolvent"), F.size("d.produkte_leistungen").alias("products"), F.size("d.nachfolge_signale").alias("signs"), F.size("d.belege").alias("quotes"),
        c("d.naechste_generation").alias("next_generation"), c("d.konfidenz").alias("confidence"), "error",
    )


@R.add(
    "g4_evidence_signals",
    """with p as (select distinct company_id from v_signals where company_id % 3 = 0) select company_id, signal_type, zitat, url from v_signals where company_id not in (select * from p)
    union all select company_id, coalesce(nullif(trim(signal_type), ''), 'sonstiges'), zitat, url from v_signals where company_id % 3 = 0 and trim(zitat) <> '' and trim(coalesce(url, '')) <> ''""",
    ("v_signals",),
)
def g4(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = fixture(spark, sf_dir, "v_signals")
    new = signals.filter("company_id % 3 = 0")
    return evidence.evidence_signals(signals, new, new)


@R.add(
    "g4_evidence_counts",
    """select company_id, count(*) filter (trim(zitat) <> '' and trim(coalesce(url, '')) <> '') as n_signals, count(*) filter (trim(zitat) = '' or trim(coalesce(url, '')) = '') as dropped from v_signals group by 1""",
    ("v_signals",),
)
def g4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.evidence_counts(fixture(spark, sf_dir, "v_signals"))


QUOTES = r"""norm(s) as (select 1), q as (select company_id, trim(regexp_replace(replace(lower(zitat), chr(160), ' '), '\s+', ' ', 'g'), ' "''.,;:!?-') as quote, item_id from v_signals),
 t as (select item_id, trim(regexp_replace(replace(lower(text), chr(160), ' '), '\s+', ' ', 'g')) as body from benchmark)""".replace("norm(s) as (select 1), ", "")


@R.add(
    "g5_quote_fidelity",
    rf"""with {QUOTES}, j as (select company_id, quote, body, string_split(quote, ' ') as w from q left join (select s.company_id as cid, string_agg(body, ' ' order by item_id) as body from (select distinct company_id, item_id from v_signals where item_id % 3 <> 0) s join t using (item_id) group by 1) b on b.cid = q.company_id ),
    k as (select company_id, case when len(w) >= 6 then len(list_filter(range(1, len(w) - 4), lambda i: contains(coalesce(body, ''), array_to_string(w[i : i + 5], ' ')))) > 0 else length(quote) >= 8 and contains(coalesce(body, ''), quote) end as ok from j)
    select company_id, count(*) as total, count(*) filter (ok) as ok from k group by 1""",
    ("v_signals",),
)
def g5(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = fixture(spark, sf_dir, "v_signals")
    parts = signals.filter("item_id % 3 != 0").select("company_id", "item_id").distinct().join(table(spark, sf_dir, "benchmark"), "item_id").select("company_id", F.struct("item_id", text.norm_ws(c("text")).alias("t")).alias("x"))
    bodies = parts.groupBy("company_id").agg(F.sort_array(F.collect_list("x")).alias("xs")).select("company_id", F.array_join(F.transform("xs", lambda x: x["t"]), " ").alias("body"))
    return evidence.quote_fidelity(signals, bodies)


@R.add(
    "g6_fields_filled",
    f"""select company_id, cast(1 + (coalesce({_B('nachfolge_intern_geregelt')}, false))::int + (coalesce({_B('familienunternehmen.hinweis')}, false) or json_extract_string(dossier_json, '$.familienunternehmen.generation') is not null)::int
      + (coalesce({_B('fuehrungsstruktur.zweite_ebene_sichtbar')}, false) or coalesce({_B('fuehrungsstruktur.kaufmaennische_funktion_besetzt')}, false))::int + (json_array_length(dossier_json, '$.karriere.offene_stellen') > 0)::int
      + (coalesce({_B('negativ_filter.insolvenz_hinweis')}, false) or coalesce({_B('negativ_filter.tochter_eines_konzerns')}, false) or coalesce({_B('negativ_filter.reiner_onlineshop')}, false))::int
      + (coalesce(try_cast({_T('gruendungsjahr')} as int), 0) <> 0)::int + {' + '.join(f"({_N(f)} > 0)::int" for f in _LIST_FIELDS)} + {' + '.join(f"(coalesce({_T(f)}, '') <> '')::int" for f in _TEXT_FIELDS)} as int) as filled from v_dossiers""",
    ("v_dossiers",),
)
def g6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.fields_filled(dossiers(spark, sf_dir))


AUDIT = "audit as (select company_id, case signal_id % 3 when 0 then 'local' when 1 then 'remote' else 'small' end as backend, signal_id % 5 <> 0 as ok, signal_id % 4 as retries, length(zitat) * 3 as tokens, signal_id % 6 as quotes, signal_id % 6 - (signal_id % 6 > 2)::int as quotes_ok from v_signals)"


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, i = fixture(spark, sf_dir, "v_signals"), c("signal_id")
    return s.select(
        "company_id", F.when(i % 3 == 0, "local").when(i % 3 == 1, "remote").otherwise("small").alias("backend"), (i % 5 != 0).alias("ok"), (i % 4).alias("retries"), (F.length("zitat") * 3).alias("tokens"),
        (i % 6).alias("quotes"), (i % 6 - (i % 6 > 2).cast("int")).alias("quotes_ok"),
    )


@R.add(
    "g7_extraction_report",
    f"with {AUDIT} select backend, count(*) as calls, count(*) filter (ok) as succeeded, cast(sum(retries) as bigint) as retries, cast(sum(tokens) as bigint) as tokens, round(sum(quotes_ok) / nullif(sum(quotes), 0), 6) as fidelity, count(*) filter (quotes = 0) as without_quotes from audit group by 1",
    ("v_signals",),
)
def g7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.extraction_report(audit(spark, sf_dir))


@R.add(
    "g7_extraction_summary",
    f"""with {AUDIT}, o as (select *, retries > 1 as escalated, quotes + 3 as filled, quotes * 2 as n_signals, quotes // 3 as dropped, retries + 2 as seconds from audit)
    select count(*) as n, count(*) filter (ok) as succeeded, count(*) filter (not ok) as failed, count(*) filter (ok and retries > 0) as repaired, count(*) filter (ok and escalated) as escalated,
      cast(sum(tokens) filter (ok) as bigint) as tokens_in, cast(sum(tokens // 4) filter (ok) as bigint) as tokens_out, round(avg(seconds) filter (ok), 6) as seconds_mean, round(avg(filled) filter (ok), 6) as filled_mean,
      round(avg(quotes) filter (ok), 6) as quotes_mean, round(sum(quotes_ok) filter (ok) / nullif(sum(quotes) filter (ok), 0), 6) as fidelity, count(*) filter (ok and quotes = 0) as without_quotes,
      cast(sum(n_signals) filter (ok) as bigint) as n_signals, cast(sum(dropped) filter (ok) as bigint) as dropped from o""",
    ("v_signals",),
)
def g7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit(spark, sf_dir).select(
        "ok", "retries", "quotes", "quotes_ok", (c("retries") > 1).alias("escalated"), (c("quotes") + 3).alias("filled"), (c("quotes") * 2).alias("n_signals"), F.expr("quotes div 3").alias("dropped"),
        (c("retries") + 2).alias("seconds"), c("tokens").alias("tokens_in"), F.expr("tokens div 4").alias("tokens_out"),
    )
    return evidence.extraction_summary(rows)


@R.add(
    "g9_blind_sample",
    f"""with {SCORES}, s as (select *, sha256(cast(company_id as varchar)) as h from scored where score_klasse in ('A', 'B', 'C')), u as (select *, row_number() over (partition by cluster_branche, score_klasse order by h) as turn from s),
    p as (select *, row_number() over (partition by cluster_branche order by turn, score_klasse) as place from u)
    select cluster_branche, place, company_id, score_klasse, case when contains('13579bdf', right(h, 1)) then 'B' else 'A' end as label from p where place <= 6""",
    VIEWS,
)
def g9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.blind_sample(scores(spark, sf_dir), 6)


@R.add(
    "g10_compare_backends",
    f"""with {AUDIT}, r as (select * from audit where backend <> 'small'), s as (select company_id from r group by 1 having count(distinct backend) = 2), k as (select * from r where company_id in (select * from s))
    select 'quotes_ok' as measure, cast(sum(quotes_ok) filter (backend = 'local') as double) as local, cast(sum(quotes_ok) filter (backend = 'remote') as double) as remote from k
    union all select 'filled', cast(sum(quotes) filter (backend = 'local') as double), cast(sum(quotes) filter (backend = 'remote') as double) from k
    union all select 'seconds', cast(sum(tokens) filter (backend = 'local') as double), cast(sum(tokens) filter (backend = 'remote') as double) from k""",
    ("v_signals",),
)
def g10(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = audit(spark, sf_dir).filter("backend <> 'small'").select("company_id", "backend", "quotes_ok", c("quotes").alias("filled"), c("tokens").alias("seconds"))
    return evidence.compare_backends(records, ("local", "remote"))
