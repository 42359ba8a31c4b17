"""Queries on scoring and clustering (H, F11, G8, G11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import importing, keyed, scoring
from ..sources.fixtures import fixture
from .common import Registry, sql_any, sql_wz2
from .imports import COMPANY_KEY, HANDOVER, HOLDING, with_holding

R = Registry()
c = F.col


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_holding(fixture(spark, sf_dir, "v_companies"))
    return df.withColumn("gf_alter", F.lit(None).cast("int"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    handover = importing.handover_flag(fixture(spark, sf_dir, "v_persons"), 2024)
    return scoring.score_companies(companies(spark, sf_dir), fixture(spark, sf_dir, "v_dossiers"), handover, 2024)


def _flag(path: str) -> str:
    return f"coalesce(json_extract_string(dossier_json, '$.{path}') = 'true', false)"


_CLUSTER = " ".join(f"when wz in ({', '.join(repr(x) for x in codes)}) then '{name}'" for name, codes in config.CLUSTERS.items())
_BAND = "['klein', 'kern', 'oberes_band'][greatest(case when b is null then null when b <= 2500000 then 0 when b <= 6000000 then 1 else 2 end, case when m is null then null when m <= 20 then 0 when m <= 50 then 1 else 2 end) + 1]"
SCORES = f"""{HANDOVER}, x as (select v.*, dossier_json, {HOLDING} as holding_reason, {sql_wz2('branche_wz')} as wz, bilanzsumme_eur as b, mitarbeiterzahl as m, 2024 - gf_geburtsjahr as age, coalesce(handover, false) as ho
  from v_dossiers d join v_companies v on v.id = d.company_id left join handover on key = {COMPANY_KEY}),
h as (select *, coalesce(b between 1500000 and 10000000 and ek_quote_pct >= 0, false) as k1, coalesce(m between 10 and 50, false) as k2, gewinn_cagr_pct > 0 as k3, wz in ({', '.join(repr(w) for w in config.FOCUS_WZ)}) as k4,
  {_flag('nachfolge_intern_geregelt')} as k9, gf_name_in_firmenname as k6, {_flag('familienunternehmen.hinweis')} as k7, anzahl_gf = 1 as k8,
  coalesce(json_extract_string(dossier_json, '$.fuehrungsstruktur.kaufmaennische_funktion_besetzt') = 'false', false) as k10, {sql_any("json_extract_string(dossier_json, '$.karriere.offene_stellen')", config.ACCOUNTING_TERMS)} as k11,
  coalesce(json_extract_string(dossier_json, '$.fuehrungsstruktur.zweite_ebene_sichtbar') = 'false', false) as k12, {_flag('negativ_filter.tochter_eines_konzerns')} as k14, {_flag('negativ_filter.insolvenz_hinweis')} as k15, {_flag('negativ_filter.reiner_onlineshop')} as k17 from x),
g as (select *, coalesce(age >= 58, false) and not k9 as k5, holding_reason is not null as k13 from h),
t as (select *, cast(2 * k1::int + 2 * k2::int + k3::int + k4::int + 3 * k5::int + k6::int + k7::int + k8::int - 3 * k9::int + k10::int + 2 * k11::int + k12::int - 3 * k17::int as int) as score_total from g),
scored as (select *, id as company_id, case when k13 or k14 or k15 or ho then 'KO' when score_total >= 9 then 'A' when score_total >= 5 then 'B' else 'C' end as score_klasse,
  case {_CLUSTER} else 'rest' end as cluster_branche, {_BAND} as groessenband, case {_CLUSTER} else 'rest' end || '__' || coalesce({_BAND}, 'unbekannt') as cluster_key from t)"""
VIEWS = ("v_dossiers", "v_persons")


_PLAIN = lambda x: f"regexp_replace(cast(cast({x} as decimal(20, 4)) as varchar), '\\.?0+$', '')"


@R.add(
    "h1_score_companies",
    f"""with {SCORES} select company_id, score_total, score_klasse, k1 as balance, k5 as age, k9 as settled, k11 as jobs, ho as handover,
      case when b is null then '—' else {_PLAIN('b')} || ' EUR, EK ' || coalesce({_PLAIN('ek_quote_pct')}, '—') || ' %' end as balance_value, cast(m as varchar) as staff_value, {_PLAIN('gewinn_cagr_pct')} as growth_value, wz as industry_value,
      case when age is null then 'unbekannt' else age || ' (geburtsjahr)' || case when age >= 58 and k9 then ' — neutralisiert: Nachfolge intern geregelt' else '' end end as age_value,
      json_extract_string(dossier_json, '$.familienunternehmen.generation') as family_value, coalesce(nullif(json_extract_string(dossier_json, '$.naechste_generation'), ''), case when k9 then 'ja' end) as settled_value from scored""",
    VIEWS,
)
def h1(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = lambda path, name: c(f"breakdown.{path}.hit").alias(name)
    value = lambda path, name: c(f"breakdown.{path}.wert").alias(name)
    return scores(spark, sf_dir).select(
        "company_id", "score_total", "score_klasse", hit("anker.bilanzsumme_band", "balance"), hit("nachfolge.gf_alter_min", "age"), hit("nachfolge.nachfolge_intern_geregelt", "settled"),
        hit("web_bedarf.offene_kaufm_stelle", "jobs"), hit("abzuege.generationswechsel_vollzogen", "handover"), value("anker.bilanzsumme_band", "balance_value"), value("anker.mitarbeiter_band", "staff_value"),
        value("anker.gewinn_cagr_positiv", "growth_value"), value("anker.fokus_wz", "industry_value"), value("nachfolge.gf_alter_min", "age_value"), value("nachfolge.familienhinweis", "family_value"),
        value("nachfolge.nachfolge_intern_geregelt", "settled_value"),
    )


@R.add("h2_score_class", f"with {SCORES} select score_klasse, count(*) as n, min(score_total) as least, max(score_total) as most from scored group by 1", VIEWS)
def h2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir).groupBy("score_klasse").agg(F.count("*").alias("n"), F.min("score_total").alias("least"), F.max("score_total").alias("most"))


_BANDS = _BAND.replace(" b ", " bilanzsumme_eur ").replace(" m ", " mitarbeiterzahl ")


@R.add("h3_size_band", f"select id, {_BANDS} as band from v_companies", ("v_companies",))
def h3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", scoring.size_band(c("bilanzsumme_eur"), c("mitarbeiterzahl")).alias("band"))


@R.add("h4_cluster_key", f"with w as (select *, {sql_wz2('branche_wz')} as wz from v_companies) select id, case {_CLUSTER} else 'rest' end || '__' || coalesce({_BANDS}, 'unbekannt') as cluster_key from w", ("v_companies",))
def h4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import wz2

    return fixture(spark, sf_dir, "v_companies").select("id", scoring.cluster_key(wz2(c("branche_wz")), c("bilanzsumme_eur"), c("mitarbeiterzahl")).alias("cluster_key"))


_PAIN = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in config.PAIN_POINTS.items()) + "}"
_TRI = "case json_extract_string(dossier_json, '$.fuehrungsstruktur.{}') when 'true' then 'ja' when 'false' then 'nein' else 'unbekannt' end"


@R.add(
    "h5_briefing_text",
    rf"""with {SCORES}, k as (select *, concat_ws(', ', case when k13 then 'holding_flag' end, case when k14 then 'konzerntochter' end, case when k15 then 'insolvenz' end, case when ho then 'generationswechsel_vollzogen' end) as ko from scored),
    e as (select company_id, coalesce(nullif(signal_type, ''), 'sonstiges') as st, arg_min('"' || trim(coalesce(zitat, '')) || '" — ' || coalesce(url, ''), signal_id) as q from v_signals group by 1, 2),
    f as (select company_id, string_agg('  [' || st || '] ' || q, chr(10) order by st) as quotes from e group by 1)
    select k.company_id, concat_ws(chr(10), name || ' — Score ' || score_total || ' (Klasse ' || score_klasse || ')' || case when ko <> '' then '  [K.o.: ' || ko || ']' else '' end,
      'Standort ' || ort || ' · WZ ' || wz || ' · Cluster ' || cluster_key, 'Schmerzpunkt (Brief): ' || {_PAIN}[cluster_branche], '',
      'Kennzahlen: Bilanzsumme ' || coalesce(replace(format('{{:,}}', cast(b as bigint)), ',', '.') || ' EUR', '—') || ', EK-Quote ' || coalesce(cast(ek_quote_pct as varchar), '—') || ' %, MA ' || coalesce(cast(m as varchar), '—')
        || ', Gewinn-CAGR ' || coalesce(cast(gewinn_cagr_pct as varchar), '—') || ' %',
      'Nachfolge: GF-Alter ' || coalesce(cast(age as varchar), 'unbekannt') || ', GF-Name im Firmennamen: ' || case when k6 then 'ja' else 'nein' end || ', Familienunternehmen: ' || case when k7 then 'ja' else 'nein' end || ', Anzahl GF: ' || anzahl_gf,
      case when json_array_length(dossier_json, '$.nachfolge_signale') > 0 then '  Signale: ' || array_to_string(from_json(json_extract(dossier_json, '$.nachfolge_signale'), '["VARCHAR"]'), '; ') end,
      case when k9 then '  ACHTUNG Nachfolge intern geregelt: ' || coalesce(nullif(json_extract_string(dossier_json, '$.naechste_generation'), ''), 'nächste Generation steht bereit') end,
      'Web-Bedarf: kaufm. Funktion besetzt: ' || {_TRI.format('kaufmaennische_funktion_besetzt')} || ', 2. Ebene sichtbar: ' || {_TRI.format('zweite_ebene_sichtbar')} || ', offene kaufm. Stellen: —',
      case when quotes is not null then chr(10) || 'Belege:' || chr(10) || quotes end) as briefing from k left join f on f.company_id = k.company_id""",
    (*VIEWS, "v_signals"),
)
def h5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.outreach import first_evidence

    evidence = first_evidence(fixture(spark, sf_dir, "v_signals"))
    return scoring.briefing_text(scores(spark, sf_dir), fixture(spark, sf_dir, "v_companies"), fixture(spark, sf_dir, "v_dossiers"), evidence)


_NAMES = [n for rules in ("bilanzsumme_band mitarbeiter_band gewinn_cagr_positiv fokus_wz", "gf_alter_min gf_name_in_firmenname familienhinweis nur_ein_gf nachfolge_intern_geregelt", "keine_kaufm_funktion offene_kaufm_stelle zweite_ebene_unsichtbar", "holding_flag konzerntochter insolvenz") for n in rules.split()]
_HITS = " union all ".join(f"select '{n}' as criterion, count(*) filter (k{i + 1}) as hits, count(*) as n from scored" for i, n in enumerate(_NAMES))


@R.add("h6_criterion_hits", f"with {SCORES} {_HITS} union all select 'generationswechsel_vollzogen', count(*) filter (ho), count(*) from scored union all select 'reiner_onlineshop', count(*) filter (k17), count(*) from scored", VIEWS)
def h6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.criterion_hits(scores(spark, sf_dir))


@R.add(
    "h6_score_report",
    f"""with {SCORES} select 'klasse' as kind, score_klasse as value, count(*) as n from scored group by 2 union all select 'score', cast(score_total as varchar), count(*) from scored group by 2
    union all select 'cluster', cluster_key, count(*) from scored group by 2
    union all select 'alter', case when age is not null then 'bekannt' else 'unbekannt' end, count(*) from scored group by 2""",
    VIEWS,
)
def h6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_report(scores(spark, sf_dir))


@R.add(
    "h7_top_per_cluster",
    f"with {SCORES}, p as (select *, row_number() over (partition by cluster_key order by score_total desc, company_id) as place from scored) select cluster_key, place, company_id, score_total from p where place <= 5",
    VIEWS,
)
def h7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.top_per_cluster(scores(spark, sf_dir), 5).select("cluster_key", "place", "company_id", "score_total")


@R.add("h7_best_per_class", f"with {SCORES} select score_klasse, arg_min(company_id, (-score_total, company_id)) as company_id, max(score_total) as score_total, arg_min(cluster_key, (-score_total, company_id)) as cluster_key from scored group by 1", VIEWS)
def h7_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.best_per_class(scores(spark, sf_dir)).select("score_klasse", "company_id", "score_total", "cluster_key")


@R.add(
    "h8_unscored",
    "select company_id, case when company_id + 1200 not in (select id from v_companies) then 'company missing' end as error from (select company_id from v_dossiers where company_id % 4 <> 0) d".replace("company_id + 1200", "company_id * 3"),
    ("v_dossiers", "v_companies"),
)
def h8(spark: SparkSession, sf_dir: str) -> DataFrame:
    dossiers = fixture(spark, sf_dir, "v_dossiers").select((c("company_id") * 3).alias("company_id"))
    done = fixture(spark, sf_dir, "v_dossiers").filter("company_id % 4 = 0").select((c("company_id") * 3).alias("company_id"))
    return scoring.unscored(dossiers, done, fixture(spark, sf_dir, "v_companies")).select((c("company_id") / 3).cast("long").alias("company_id"), "error")


@R.add("h9_recompute_check", f"with {SCORES} select count(*) as n, count(*) as identical from scored", VIEWS)
def h9(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = scores(spark, sf_dir).repartition(7, "score_total")
    return keyed.identical_share(scores(spark, sf_dir), again, "company_id", ["score_total", "score_klasse", "breakdown"])


CRAWL = f"""crawl as (select *, {HOLDING} as holding_reason, case when id % 8 = 0 then null else 'http://x' || id end as website, 2024 - gf_geburtsjahr as gf_alter,
  case id % 5 when 0 then null when 1 then '{{"reachable":true}}' when 2 then '{{"reachable":false}}' when 3 then '{{"reachable":true,"no_text_content":true}}' else null end as tech_signals from v_companies)"""


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    tech = F.when(c("id") % 5 == 1, '{"reachable":true}').when(c("id") % 5 == 2, '{"reachable":false}').when(c("id") % 5 == 3, '{"reachable":true,"no_text_content":true}')
    df = with_holding(fixture(spark, sf_dir, "v_companies")).withColumn("website", F.when(c("id") % 8 != 0, F.concat(F.lit("http://x"), c("id").cast("string")))).withColumn("tech_signals", tech)
    return df.withColumn("dup_of", F.lit(None).cast("long")).withColumn("excluded", F.lit(False)).withColumn("gf_alter", F.lit(2024) - c("gf_geburtsjahr"))


@R.add(
    "h10_age_backlog",
    f"""with {CRAWL} select id from crawl where website is not null and holding_reason is null and gf_alter >= 58 and id % 5 in (0, 1, 4) and id not in (select company_id from v_dossiers where company_id % 2 = 0)""",
    ("v_dossiers", "v_companies"),
)
def h10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fixture(spark, sf_dir, "v_dossiers").filter("company_id % 2 = 0").select("company_id")
    return scoring.age_backlog(crawled(spark, sf_dir), done, 58)


@R.add(
    "f11_crawl_candidates",
    f"""with {CRAWL} select id, prioritaets_score, bilanzsumme_eur from crawl where website is not null and holding_reason is null and tech_signals is null and prioritaets_score >= 1.5
      order by prioritaets_score desc, coalesce(bilanzsumme_eur, -1) desc, id limit 100""",
    ("v_companies",),
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.crawl_candidates(crawled(spark, sf_dir), min_score=1.5, limit=100).select("id", "prioritaets_score", "bilanzsumme_eur")


@R.add(
    "g8_stratified_round_robin",
    """with r as (select id, ort, prioritaets_score as p, row_number() over (partition by ort order by coalesce(prioritaets_score, -1) desc, id) as k, count(*) over (partition by ort) as n from v_companies),
    s as (select ort, row_number() over (order by n desc, coalesce(p, -1) desc, id) as q from r where k = 1)
    select id, ort from r join s using (ort) order by k, q limit 130""",
    ("v_companies",),
)
def g8(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc(F.coalesce("prioritaets_score", F.lit(-1.0))), F.asc("id")]
    return keyed.stratified_round_robin(fixture(spark, sf_dir, "v_companies"), "ort", order, 130).select("id", "ort")


@R.add(
    "g11_even_spread_sample",
    """with r as (select id, row_number() over (order by bilanzsumme_eur desc nulls last, id) - 1 as place, count(*) over () as n from v_companies)
    select id from r where place in (select cast(round_even(j * (n - 1) / 24, 0) as bigint) from (select unnest(range(25)) as j, (select count(*) from v_companies) as n))""",
    ("v_companies",),
)
def g11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.even_spread_sample(fixture(spark, sf_dir, "v_companies"), [F.desc_nulls_last("bilanzsumme_eur"), F.asc("id")], 25).select("id")
