"""Queries on advertisements and their matches (E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..operators import search, signals
from ..sources.fixtures import fixture
from ..sources.io import scratch_folder, written
from .common import Registry, sql_any, sql_bare, sql_norm_company, sql_norm_text, sql_one_decimal, sql_ratio, sql_subset

R = Registry()
c = F.col

# --- shared inputs ----------------------------------------------------------------------------------------------------


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested advertisements: every third has a second place, that of another company."""
    other = fixture(spark, sf_dir, "v_companies").filter("id between 1 and 1999").select((c("id") - 1).alias("other"), c("plz").alias("plz2"), c("ort").alias("ort2"))
    rows = fixture(spark, sf_dir, "v_postings").withColumn("other", F.when(c("posting_id") % 3 == 0, c("posting_id") % 1999)).join(F.broadcast(other), "other", "left")  # 1,999 rows
    place = lambda plz, ort: F.struct(F.struct(c(plz).alias("plz"), c(ort).alias("ort")).alias("adresse"))
    places = F.when(c("plz2").isNotNull(), F.array(place("plz", "ort"), place("plz2", "ort2"))).otherwise(F.array(place("plz", "ort")))
    ad = F.struct(
        c("refnr").alias("referenznummer"), c("titel").alias("stellenangebotsTitel"), c("beruf").alias("hauptberuf"), c("arbeitgeber").alias("firma"),
        c("veroeffentlicht_am").cast("string").alias("datumErsteVeroeffentlichung"), places.alias("stellenlokationen"),
    )
    return rows.select(F.to_json(ad).alias("payload"), "keyword")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.parse_postings(raw_ads(spark, sf_dir))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").withColumn("dup_of", F.lit(None).cast("long")).withColumn("gf_alter", F.lit(2024) - c("gf_geburtsjahr"))


LOCS = """locs as (select refnr, 0 as pos, plz, ort from v_postings union all
 select p.refnr, 1, x.plz, x.ort from v_postings p join v_companies x on x.id - 1 = p.posting_id % 1999 where p.posting_id % 3 = 0)"""
LOCATED = f"""{LOCS}, f as (select refnr, plz, min(pos) as pos, arg_min({sql_norm_text('ort')}, pos) as place from locs where trim(coalesce(plz, '')) <> '' group by 1, 2),
 ads as (select f.*, substr(f.plz, 1, 3) as prefix, {sql_norm_company('arbeitgeber')} as employer from f join v_postings using (refnr)),
 firms as (select id, plz, substr(plz, 1, 3) as prefix, {sql_norm_company('name')} as company, 2024 - gf_geburtsjahr as gf_alter from v_companies)"""
EXACT = "exact as (select distinct refnr, id as company_id, 'exakt' as match_stufe, 100.0::double as match_score, gf_alter from ads join firms on ads.plz = firms.plz and employer = company where employer <> '')"
REGION = "region as (select distinct refnr, id as company_id, 'region' as match_stufe, 100.0::double as match_score, gf_alter from ads join firms on ads.prefix = firms.prefix and employer = company where employer <> '')"

PAIRED = f"""fz as (select refnr, id as company_id, gf_alter, {sql_bare('employer', 'place')} as a, {sql_bare('company', 'place')} as b from ads join firms using (plz) where employer <> company and employer <> '' and company <> ''),
 firsts as (select refnr, employer, prefix, arg_min(place, pos) as place from ads group by all),
 rg as (select refnr, id as company_id, gf_alter, {sql_bare('employer', 'place')} as a, {sql_bare('company', 'place')} as b from firsts join firms using (prefix) where employer <> company and employer <> '' and company <> ''),
 names as (select a, b from fz union all select a, b from rg), {sql_ratio('names')},
 fuzzy as (select refnr, company_id, case when score >= {config.FUZZY_AUTO} and not {sql_subset('a', 'b')} then 'fuzzy' else 'fuzzy_grenzfall' end as match_stufe, score as match_score, gf_alter from fz join ratio using (a, b) where score >= {config.FUZZY_REVIEW}),
 near as (select * from region union all select refnr, company_id, 'region', score, gf_alter from rg join ratio using (a, b) where score >= {config.REGION_MIN} and not {sql_subset('a', 'b')})"""
_ORDER = f"case match_stufe {' '.join(f"when '{k}' then {v}" for k, v in config.STAGE_RANK.items())} end"
BEST = f"""{LOCATED}, {EXACT}, {REGION}, {PAIRED}, every as (select * from exact union all select * from fuzzy union all select * from near),
 best as (select refnr, company_id, match_stufe, {sql_one_decimal('match_score')} as match_score, gf_alter from (select *, row_number() over (partition by refnr, company_id order by {_ORDER}, match_score desc) as place from every) where place = 1)"""

POSITIVE = [p for _, parts in config.KEYWORD_GROUPS.values() for p in parts]
NORMED = f"n as (select *, {sql_norm_text('titel')} as title_n, {sql_norm_text('beruf')} as job_n from v_postings)"
BAD = f"{sql_any('title_n', config.TITLE_EXCLUDE)} or {sql_any('job_n', config.OCCUPATION_EXCLUDE)}"
GOOD = sql_any("title_n || ' ' || job_n", POSITIVE)


@R.add(
    "e1_parse_postings",
    "select refnr, titel, beruf, arbeitgeber, plz, ort, cast(veroeffentlicht_am as varchar) as veroeffentlicht_am, keyword from v_postings",
    ("v_postings",),
)
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spark, sf_dir).drop("places")


@R.add("e2_explode_locations", f"with {LOCS} select * from locs", ("v_postings",))
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.explode_locations(postings(spark, sf_dir))


@R.add("e3_title_filter", f"with {NORMED} select refnr, titel from n where not ({BAD}) and {GOOD}", ("v_postings",))
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.title_filter(postings(spark, sf_dir)).select("refnr", "titel")


_BY_GROUP = " or ".join(f"(keyword in ({', '.join(repr(w) for w in words)}) and {sql_any("title_n || ' ' || job_n", parts)})" for words, parts in config.KEYWORD_GROUPS.values())


@R.add("e3_title_filter_by_group", f"with {NORMED} select refnr, titel, keyword from n where not ({BAD}) and ({_BY_GROUP})", ("v_postings",))
def e3_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.title_filter(postings(spark, sf_dir), by_group=True).select("refnr", "titel", "keyword")


@R.add("e4_exclude_employers", f"select refnr, arbeitgeber from v_postings where not {sql_any('arbeitgeber', ('ivory', 'Holding'))}", ("v_postings",))
def e4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.exclude_employers(postings(spark, sf_dir), ("ivory", "Holding")).select("refnr", "arbeitgeber")


HITS = "hits as (select *, 'R' || cast(posting_id % 4000 as varchar) as ref from v_postings)"


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping scans: several hits have one advertisement id."""
    return fixture(spark, sf_dir, "v_postings").withColumn("refnr", F.concat(F.lit("R"), (c("posting_id") % 4000).cast("string")))


@R.add("e5_scan_dedupe", f"with {HITS} select ref as refnr, arg_min(posting_id, (keyword, posting_id)) as posting_id from hits group by 1", ("v_postings",))
def e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.scan_dedupe(hits(spark, sf_dir), ["keyword", "posting_id"]).select("refnr", "posting_id")


@R.add("e5_scan_counts", f"with {NORMED} select keyword, count(*) as hits, count(*) - count(*) filter (not ({BAD}) and {GOOD}) as dropped from n group by keyword", ("v_postings",))
def e5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.scan_counts(hits(spark, sf_dir))


@R.add("e6_published_within", "select posting_id from v_postings where veroeffentlicht_am >= date '1998-08-02' - 28", ("v_postings",))
def e6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.published_within(fixture(spark, sf_dir, "v_postings"), "1998-08-02", 20).select("posting_id")


@R.add("e7_match_exact", f"with {LOCATED}, {EXACT} select * from exact", ("v_postings",))
def e7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.match_exact(signals.located(postings(spark, sf_dir)), signals.matchable(companies(spark, sf_dir)))


@R.add("e8_match_fuzzy", f"with {LOCATED}, {EXACT}, {REGION}, {PAIRED} select * from fuzzy", ("v_postings",))
def e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.match_fuzzy(signals.located(postings(spark, sf_dir)), signals.matchable(companies(spark, sf_dir)))


@R.add("e9_match_region", f"with {LOCATED}, {EXACT}, {REGION}, {PAIRED} select * from near", ("v_postings",))
def e9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.match_region(signals.located(postings(spark, sf_dir)), signals.matchable(companies(spark, sf_dir)))


def all_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.match_postings(postings(spark, sf_dir), companies(spark, sf_dir))


@R.add("e10_match_postings", f"with {BEST} select * from best", ("v_postings",))
def e10_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_stages(spark, sf_dir)


@R.add("e10_best_match", f"with {BEST} select * from best", ("v_postings",))
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_stages(spark, sf_dir)


PRIO = "case when gf_alter is null then 'unbekannt' when gf_alter >= 58 then 'hoch' when gf_alter >= 50 then 'mittel' else 'niedrig' end"


@R.add(
    "flagship_leading_roles",
    f"with {BEST}, {NORMED} select best.*, {PRIO} as prio from best join n using (refnr) where not ({BAD}) and {GOOD}",
    ("v_postings",),
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which companies advertise a leading commercial role, at their place or in their region?"""
    chosen = signals.title_filter(postings(spark, sf_dir))
    return signals.match_postings(chosen, companies(spark, sf_dir)).withColumn("prio", text.age_priority(c("gf_alter")))


@R.add("e11_unmatched_without_plz", f"with {LOCS} select count(*) as n from (select refnr from v_postings except select refnr from locs where trim(coalesce(plz, '')) <> '')", ("v_postings",))
def e11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.unmatched_without_plz(postings(spark, sf_dir))


KEYS = f"keys as (select refnr, posting_id, {sql_norm_company('arbeitgeber')} as employer_key, {sql_norm_text('titel')} as title_key, coalesce(cast(veroeffentlicht_am as varchar), '9999') as day from v_postings)"
CLAIMED = "claimed as (select employer_key, title_key, company_id from v_matches m join keys using (posting_id) where status in ('relevant', 'outreach'))"


def claimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fixture(spark, sf_dir, "v_matches").filter(c("status").isin("relevant", "outreach"))
    keys = fixture(spark, sf_dir, "v_postings").select("posting_id", text.norm_company(c("arbeitgeber")).alias("employer_key"), text.norm_text(c("titel")).alias("title_key"))
    return stored.join(keys.hint("merge"), "posting_id").select("employer_key", "title_key", "company_id")


@R.add(
    "e12_dedupe_reposts",
    f"""with {BEST}, {KEYS}, {CLAIMED}, k as (select best.*, row_number() over (partition by employer_key, title_key, company_id order by day, refnr) as r from best join keys using (refnr)
      where (employer_key, title_key, company_id) not in (select (employer_key, title_key, company_id) from claimed where company_id is not null))
    select refnr, company_id, match_stufe, match_score, gf_alter from k where r = 1""",
    ("v_matches",),
)
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.first_reposts(postings(spark, sf_dir), signals.matchable(companies(spark, sf_dir)), claimed(spark, sf_dir))


@R.add(
    "e13_upsert_sightings",
    """with e as (select refnr, titel, timestamp '2024-01-01' as f from v_postings where posting_id % 2 = 0), b as (select refnr, upper(titel) as titel from v_postings where posting_id % 3 = 0)
    select refnr, coalesce(b.titel, e.titel) as titel, coalesce(f, timestamp '2024-02-01') as first_seen, case when b.refnr is not null then timestamp '2024-02-01' else f end as last_seen from e full join b using (refnr)""",
    ("v_postings",),
)
def e13(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "v_postings")
    old = F.lit("2024-01-01").cast("timestamp")
    existing = df.filter("posting_id % 2 = 0").select("refnr", "titel", old.alias("first_seen"), old.alias("last_seen"))
    return signals.upsert_sightings(existing, df.filter("posting_id % 3 = 0").select("refnr", F.upper("titel").alias("titel")), "2024-02-01")


def stored_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertisements with the posting_id under which they are stored."""
    return postings(spark, sf_dir).join(fixture(spark, sf_dir, "v_postings").select("refnr", "posting_id").hint("merge"), "refnr")


def resolved_names(spark: SparkSession, sf_dir: str, firms: DataFrame) -> DataFrame:
    """The names that each advertisement matches, with its posting_id."""
    return signals.matched_names(signals.located(stored_ads(spark, sf_dir), "posting_id"), firms, "posting_id")


STORED = "stored as (select posting_id, company_id, match_stufe, match_score, prio, status from v_matches)"


@R.add(
    "e14_insert_matches",
    f"""with {BEST}, {STORED} select * from stored union all select posting_id, company_id, match_stufe, match_score, {PRIO}, 'neu' from best join v_postings using (refnr)
      where not exists (select 1 from stored s where s.posting_id = v_postings.posting_id and s.company_id = best.company_id)""",
    ("v_matches",),
)
def e14(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = signals.matchable(companies(spark, sf_dir))
    return signals.insert_name_matches(fixture(spark, sf_dir, "v_matches"), resolved_names(spark, sf_dir, firms), firms)


@R.add(
    "e15_reconcile_matches",
    f"""with {BEST}, w as (select posting_id, company_id, match_stufe, match_score from best join v_postings using (refnr)), h as (select * from v_matches where company_id is not null),
    b as (select coalesce(w.posting_id, h.posting_id) as posting_id, coalesce(w.company_id, h.company_id) as company_id,
      case when h.match_id is null then 'insert' when h.status = 'neu' and w.posting_id is null then 'delete'
        when h.status = 'neu' and (h.match_stufe is distinct from w.match_stufe or h.match_score is distinct from w.match_score) then 'update' end as action, w.match_stufe, w.match_score
      from w full join h on w.posting_id = h.posting_id and w.company_id = h.company_id)
    select * from b where action is not null""",
    ("v_matches",),
)
def e15(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = signals.matchable(companies(spark, sf_dir))
    names = written(resolved_names(spark, sf_dir, firms), "names")
    return signals.reconcile_names(names, fixture(spark, sf_dir, "v_matches"), firms)


# second names of queries that once took equal names only
for _name in ("flagship_leading_roles", "e12_dedupe_reposts", "e14_insert_matches", "e15_reconcile_matches"):
    R.alias(f"{_name}_all_stages", _name)


@R.add(
    "e15_rematch",
    f"""with {BEST}, {NORMED}, {KEYS}, held as (select posting_id from v_matches where status is distinct from 'neu' or company_id is null),
    gone as (select posting_id from n where ({BAD} or not {GOOD}) and posting_id not in (select posting_id from held)),
    claims as (select employer_key, title_key, company_id from v_matches join keys using (posting_id) where status is distinct from 'neu' and company_id is not null and posting_id not in (select posting_id from gone)),
    d as (select posting_id, best.*, row_number() over (partition by employer_key, title_key, company_id order by day, refnr) as turn from best join keys using (refnr)
      where posting_id not in (select posting_id from gone) and (employer_key, title_key, company_id) not in (select (employer_key, title_key, company_id) from claims)),
    w as (select posting_id, company_id, match_stufe, match_score from d where turn = 1), h as (select * from v_matches where company_id is not null),
    b as (select coalesce(w.posting_id, h.posting_id) as posting_id, coalesce(w.company_id, h.company_id) as company_id,
      case when h.match_id is null then 'insert' when h.status = 'neu' and w.posting_id is null then 'delete'
        when h.status = 'neu' and (h.match_stufe is distinct from w.match_stufe or h.match_score is distinct from w.match_score) then 'update' end as action, w.match_stufe, w.match_score
      from w full join h on w.posting_id = h.posting_id and w.company_id = h.company_id)
    select * from b where action is not null union all select posting_id, null, 'delete_posting', null, null from gone""",
    ("v_matches",),
)
def e15_rematch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.rematch(stored_ads(spark, sf_dir), fixture(spark, sf_dir, "v_matches"), companies(spark, sf_dir))


@R.add("e15_match_changes", f"with {BEST} select * from best", ("v_postings",))
def e15_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run saw other names of some employers and companies, lacked some of either and had some that are gone."""
    ads, firms = written(postings(spark, sf_dir), "postings"), written(companies(spark, sf_dir), "companies")
    id_ = F.substring("refnr", 2, 20).cast("long")
    old_ads = ads.filter(id_ % 61 != 0).withColumn("arbeitgeber", F.when(id_ % 53 == 0, F.concat(F.lit("Alt "), c("arbeitgeber"))).otherwise(c("arbeitgeber")))
    old_ads = old_ads.unionByName(ads.filter(id_ % 47 == 0).withColumn("refnr", F.concat(F.lit("X"), c("refnr"))))
    old_firms = firms.filter("id % 59 != 0").withColumn("name", F.when(c("id") % 43 == 0, F.upper(F.reverse("name"))).otherwise(c("name")))
    last = signals.first_run(old_ads, signals.matchable(old_firms))
    chosen = signals.matchable(firms)
    return signals.expand(signals.next_run(ads, chosen, last).matched, chosen)


@R.add(
    "e16_refresh_priority",
    f"""with a as (select id as company_id, 2024 - gf_geburtsjahr as gf_alter from v_companies), m as (select match_id, prio, {PRIO} as new_prio from v_matches left join a using (company_id) where company_id is not null and status not in ('irrelevant', 'abgelehnt'))
    select match_id, new_prio from m where new_prio <> prio""",
    ("v_matches",),
)
def e16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.refresh_priority(fixture(spark, sf_dir, "v_matches"), companies(spark, sf_dir))


@R.add(
    "e17_signal_counts",
    """with j as (select m.*, p.keyword, coalesce(strftime(veroeffentlicht_am, '%Y-%m'), 'unbekannt') as month from v_matches m left join v_postings p using (posting_id))
    select 'status' as kind, status as value, count(*) as n from j group by 2 union all select 'prio', prio, count(*) from j group by 2 union all select 'stufe', match_stufe, count(*) from j group by 2
    union all select 'monat', month, count(*) from j group by 2 union all select 'keyword', keyword, count(*) from j group by 2""",
    ("v_matches",),
)
def e17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signal_counts(fixture(spark, sf_dir, "v_matches"), fixture(spark, sf_dir, "v_postings"))


@R.add(
    "e17_signal_rates",
    """with f as (select distinct company_id from v_matches where status in ('relevant', 'outreach', 'abgelehnt') and company_id is not null)
    select count(*) as companies, count(*) filter (company_id in (select company_id from v_outreach where channel = 'letter')) as with_letter,
      count(*) filter (company_id in (select company_id from v_calls where outcome in ('gesprochen', 'termin', 'rueckruf_vereinbart'))) as talked from f""",
    ("v_matches", "v_outreach", "v_calls"),
)
def e17_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signal_rates(*[fixture(spark, sf_dir, v) for v in ("v_matches", "v_outreach", "v_calls")])


STAGE = "case match_stufe when 'exakt' then 0 when 'fuzzy' then 1 when 'region' then 2 when 'fuzzy_grenzfall' then 3 end"
RANK = "case prio when 'hoch' then 0 when 'mittel' then 1 when 'niedrig' then 2 else 3 end"


@R.add("e18_match_sample", f"select match_id, match_stufe, prio, match_score from v_matches order by {STAGE} nulls last, {RANK}, match_score desc nulls last, match_id limit 40", ("v_matches",))
def e18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.match_sample(fixture(spark, sf_dir, "v_matches"), 40).select("match_id", "match_stufe", "prio", "match_score")


_KFM = ", ".join(repr(w) for w in config.KEYWORD_GROUPS["kfm_ltg"][0])


@R.add(
    "e19_open_reposts",
    f"""with {KEYS}, o as (select k.*, trim(coalesce(p.plz, '') || ' ' || coalesce(ort, '')) as place from keys k join v_postings p using (posting_id) where posting_id not in (select posting_id from v_matches) and keyword not in ({_KFM})),
    b as (select employer_key, title_key, arg_min(refnr, (day, refnr)) as refnr, count(*) as n, list_sort(list(distinct place)) as p from o group by 1, 2)
    select employer_key, title_key, refnr, n, array_to_string(p, ', ') as places, case when len(p) > 1 then len(p) || ' Orte: ' || p[1] || ' …' else p[1] end as place_label from b""",
    ("v_matches",),
)
def e19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.open_reposts(fixture(spark, sf_dir, "v_postings"), fixture(spark, sf_dir, "v_matches"), "contr_fibu")


@R.add(
    "e20_external_leads",
    f"""with {KEYS}, o as (select * from keys where posting_id not in (select posting_id from v_matches)),
    d as (select employer_key, title_key, case count(*) % 3 when 0 then 'neu' when 1 then 'relevant' else 'irrelevant' end as status, case when count(*) % 2 = 0 then 'note' else '' end as note from o group by 1, 2)
    select posting_id, cast(null as bigint) as company_id, 'extern' as match_stufe, 'unbekannt' as prio, status, note from d join o using (employer_key, title_key) where status <> 'neu' or note <> ''""",
    ("v_matches",),
)
def e20(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "v_postings").join(fixture(spark, sf_dir, "v_matches").select("posting_id"), "posting_id", "left_anti")
    members = df.select("posting_id", text.norm_company(c("arbeitgeber")).alias("employer_key"), text.norm_text(c("titel")).alias("title_key"))
    n = F.count("*")
    decisions = members.groupBy("employer_key", "title_key").agg(F.when(n % 3 == 0, "neu").when(n % 3 == 1, "relevant").otherwise("irrelevant").alias("status"), F.when(n % 2 == 0, "note").otherwise("").alias("note"))
    return signals.external_leads(decisions, members)


_WORDS = ("Leiter", "gmbh", "na", "NATION")
_HAY = "lower(concat_ws(' ', name, arbeitgeber, titel, p.ort, p.plz))"


@R.add(
    "e21_indexed_search",
    f"""select match_id, arbeitgeber, name from v_matches left join v_postings p using (posting_id) left join v_companies x on x.id = company_id where {' and '.join(f"contains({_HAY}, '{w.lower()}')" for w in _WORDS)}""",
    ("v_matches",),
)
def e21_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's texts in an index of grams, and words looked up in it."""
    matches, ads, firms = (fixture(spark, sf_dir, v) for v in ("v_matches", "v_postings", "v_companies"))
    rows = written(signals.review_texts(matches, ads, firms), "queue")
    path = scratch_folder(spark, "grams")
    search.write_index(rows, "match_id", c("hay"), path)
    return search.search(rows, "match_id", c("hay"), spark.read.parquet(path), _WORDS).select("match_id", "arbeitgeber", "name")


@R.add(
    "e21_review_queue",
    """select match_id, posting_id, arbeitgeber, name from v_matches left join v_postings p using (posting_id) left join v_companies x on x.id = company_id
    where status in ('neu', 'gesichtet') and prio <> 'unbekannt' and contains(lower(concat_ws(' ', name, arbeitgeber, titel, p.ort, p.plz)), 'leiter') and contains(lower(concat_ws(' ', name, arbeitgeber, titel, p.ort, p.plz)), 'gmbh')""",
    ("v_matches",),
)
def e21(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [fixture(spark, sf_dir, v) for v in ("v_matches", "v_postings", "v_companies")]
    queue = signals.review_queue(*frames, words=("Leiter", "gmbh"), status=("neu", "gesichtet"), prio=("hoch", "mittel", "niedrig"))
    return queue.select("match_id", "posting_id", "arbeitgeber", "name")
