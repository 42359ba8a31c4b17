"""Company data derived from the driver's tables: views in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tables that the views read.
BASE = ("part", "orders", "customer", "events", "documents", "pages", "benchmark")

#: In order of dependency.
VIEWS = {
    "v_companies": """
select p_partkey as id, concat('u/', cast(p_partkey as string)) as source_url,
 concat(p_name, case when p_partkey % 7 = 0 then concat(' Nation ', cast(cast(floor(p_partkey/8) as bigint) % 25 as string)) else '' end,
  case p_partkey % 5 when 0 then ' GmbH' when 1 then ' GmbH & Co. KG' when 2 then ' AG' when 3 then ' e.K.' else ' Söhne KG' end) as name,
 cast((cast(floor(p_partkey/8) as bigint) * 7919) % 90000 + 10000 as string) as plz,
 concat('Nation ', cast(cast(floor(p_partkey/8) as bigint) % 25 as string)) as ort,
 p_type as strasse, p_brand as vertreter_1,
 concat(lpad(cast((p_partkey*31) % 99 + 1 as string),2,'0'), '.', cast(10 + (p_partkey % 9)*10 as string), ' Branche ', p_type) as branche_wz,
 case when p_partkey % 11 = 0 then null else cast((p_partkey*104729) % 12000000 as double) end as bilanzsumme_eur,
 case when p_partkey % 13 = 0 then null else cast((p_partkey*15485863) % 20000000 as double) end as umsatz_eur,
 case when p_partkey % 17 = 0 then null else cast((p_partkey*37) % 120 - 20 as double) end as ek_quote_pct,
 cast((p_partkey*53) % 40 - 10 as double) as gewinn_cagr_pct,
 case when p_partkey % 19 = 0 then null else p_size*3 end as mitarbeiterzahl,
 case when p_partkey % 23 = 0 then null else cast(p_partkey % 4 as double) + 0.5*(p_partkey % 2) end as prioritaets_score,
 case when p_partkey % 6 = 0 then null else cast(1940 + (p_partkey*13) % 55 as int) end as gf_geburtsjahr,
 cast(p_partkey % 3 + 1 as int) as anzahl_gf, p_partkey % 4 = 0 as gf_name_in_firmenname
from part
""",
    "v_postings": """
select o_orderkey as posting_id, concat('R', cast(o_orderkey as string)) as refnr,
 case o_orderkey % 4 when 0 then c.name when 1 then concat(p.p_name, ' Holding SE') when 2 then concat(p.p_name, 's ', c.ort, ' GmbH') else concat(upper(p.p_name), ' gmbh') end as arbeitgeber,
 case o_orderkey % 6 when 0 then 'Kaufmännischer Leiter (m/w/d)' when 1 then 'Leiter Rechnungswesen' when 2 then 'CFO / Geschäftsführer'
   when 3 then 'Assistenz der Geschäftsführung' when 4 then 'Vertriebsleiter' else 'Leitung Controlling' end as titel,
 case when o_orderkey % 9 = 0 then 'Ingenieur/in' when o_orderkey % 5 = 0 then null else 'Betriebsleiter/in - kaufmännisch' end as beruf,
 case when o_orderkey % 31 = 0 then null when o_orderkey % 3 = 2 then concat(substring(c.plz,1,3),'99') else c.plz end as plz,
 c.ort as ort, case when o_orderkey % 6 in (1,5) then 'Leiter Rechnungswesen' else 'Geschäftsführer' end as keyword,
 case when o_orderkey % 41 = 0 then null else cast(o_orderdate as date) end as veroeffentlicht_am
from orders join v_companies c on c.id = o_custkey join part p on p.p_partkey = o_custkey
""",
    "v_persons": """
select c_custkey as ord, c.name as firma, c.plz as plz, concat('V', cast(c_custkey % 40 as string)) as gf_vorname, c_mktsegment as gf_nachname,
 case when c_custkey % 10 = 0 then '' else concat(cast(1940 + (c_custkey*17) % 60 as string), '-01-01') end as gf_geburtsdatum,
 case when c_custkey % 4 = 0 then '0' else '1' end as ist_gf, concat('J', cast(cast(floor(c_custkey/3) as bigint) as string)) as job_key
from customer join v_companies c on c.id = cast(floor(c_custkey/3) as bigint)
""",
    "v_calls": """
select event_id as call_id, user_id as company_id, ts as called_at,
 case event_type when 'error' then 'nicht_erreicht' when 'click' then 'gesprochen' when 'view' then 'rueckruf_vereinbart' when 'purchase' then 'termin' else 'kein_interesse' end as outcome,
 case when event_id % 3 = 0 then cast(ts as date) else null end as follow_up_at from events
""",
    "v_outreach": """
select c_custkey as outreach_id, c_custkey as company_id, case when c_custkey % 5 = 0 then 'email' else 'letter' end as channel,
 cast(c_custkey % 3 + 1 as int) as wave, case c_custkey % 7 when 0 then 'sent' when 1 then 'won' when 2 then 'rejected' when 3 then 'no_response' else 'queued' end as status,
 case when c_custkey % 7 < 4 then cast('2023-11-02' as date) else null end as sent_at from customer
""",
    "v_dossiers": """
select doc_id as company_id, concat('{"geschaeftsmodell":"', lang, ' ', source, '","familienunternehmen":{"hinweis":', case when doc_id % 6 = 0 then '"true"' when doc_id % 3 = 0 then 'true' when doc_id % 6 = 1 then '"no"' else 'false' end,
 ',"generation":', case when doc_id % 4 = 0 then '2' else 'null' end, '},"fuehrungsstruktur":{"zweite_ebene_sichtbar":', case doc_id % 3 when 0 then 'true' when 1 then 'false' else 'null' end,
 ',"kaufmaennische_funktion_besetzt":', case when doc_id % 5 = 0 then 'false' else 'null' end, '},"karriere":{"offene_stellen":[', case when doc_id % 6 = 0 then '"Leiter Controlling"' else '' end, '],"kaufm_stellen":[]},',
 '"nachfolge_intern_geregelt":', case when doc_id % 9 = 0 then 'true' else 'false' end,
 case when doc_id % 4 = 1 then ',"gruendungsjahr":"1987","nachfolge_signale":["Alter","Verkauf"],"naechste_generation":"Tochter"' when doc_id % 4 = 2 then ',"gruendungsjahr":1950,"konfidenz":"hoch"' when doc_id % 4 = 3 then ',"produkte_leistungen":["Pumpen"],"gruendungsjahr":"um 1900"' else '' end,
 case when doc_id % 8 = 7 then '}' else concat(',"negativ_filter":{"insolvenz_hinweis":', case when doc_id % 37 = 0 then 'true' else 'false' end, ',"tochter_eines_konzerns":', case when doc_id % 29 = 0 then 'true' else 'false' end, ',"reiner_onlineshop":', case when doc_id % 23 = 0 then 'true' else 'false' end, '}}') end) as dossier_json
from documents
""",
    "v_export_rows": """
select o_orderkey as ord, case when o_orderkey % 53 = 0 then '' else concat('u/', cast(o_custkey as string)) end as url, concat('Firma ', cast(o_custkey as string)) as name,
 case when o_orderkey % 2 = 0 then 'A, B' else '' end as rep1, case when o_orderkey % 3 = 0 then 'C, D' else '' end as rep2, ' ' as rep3,
 case o_orderkey % 7 when 0 then concat(cast(o_custkey as string), '.500,25 €') when 1 then '12,5 %' when 2 then '-' when 3 then concat('-', cast(o_custkey as string), '.000')
  when 4 then 'k.A.' when 5 then '1.5' else concat('+', cast(o_custkey as string), ' x') end as bilanz_raw
from orders
""",
    "v_raw_jobs": """
select posting_id as id, case posting_id % 3 when 0 then 'indeed' when 1 then 'stepstone' else 'arbeitsagentur' end as source,
 case posting_id % 3 when 0 then concat('{"jobId":"', refnr, '","company":"', arbeitgeber, '","title":"', titel, '","location":"', ort, '","datePosted":', cast(1704067200000 + posting_id*60000 as string), ',"isRemote":', case when posting_id % 5 = 0 then 'true' else 'false' end, '}')
  when 1 then concat('{"id":"', refnr, '","company":"","companyName":"', arbeitgeber, '","title":"', titel, '","city":"Kassel, Hessen","publishDate":"2024-02-03T10:00:00Z"}')
  else concat('{"refnr":"', refnr, '","company":"', arbeitgeber, '","title":"', titel, '","location":"Kiel","posted_at":"2024-03-04","contact_firstname":"V","contact_lastname":"N","description_snippet":"Homeoffice, Buchhaltung"}') end as payload
from v_postings
""",
    "v_pages": """
select page_id, cast(floor(page_id / 6) as bigint) as company_id, url, case page_id % 9 when 0 then 'home' when 1 then 'about' when 2 then 'historie' when 3 then 'team' when 4 then 'karriere' when 5 then 'produkte' when 6 then 'referenzen' when 7 then 'news' else 'impressum' end as page_type,
 concat(case page_id % 8 when 0 then '<meta name="generator" content="WordPress 6.4">' when 1 then '<meta name="generator" content="TYPO3 CMS 9">' when 2 then '<meta name="generator" content="Joomla! 4">'
   when 3 then '<script src="/_next/a.js"></script>' when 4 then '<p>sedoparking</p>' when 5 then '<img src="/wp-content/a.png">' else '' end,
  case when page_id % 2 = 0 then '<meta name="viewport" content="width=device-width">' else '' end,
  case when page_id % 3 = 0 then '<video src="a"></video>' else '' end, case when page_id % 4 = 0 then '<a href="/karriere">Jobs</a><a href="/ueber-uns">Firma</a>' else '' end,
  case page_id % 7 when 0 then '<a href=jobs.html>Jobs</a>' when 1 then '<a href="//other.example/ueber-uns">About</a><a href="team/./x/../">Wir</a>' when 2 then '<A class=x HREF = "../news/?p=1#top">Aktuelles</A>'
   when 3 then '<a href="?seite=2&amp;x=1">Unser <b>Team</b></a>' when 4 then '<a title="a>b" href="mailto:a@b.de">Karriere</a><a data-href="/team" href="#x">Produkte</a>' when 5 then '<!-- <a href="/karriere">alt</a> --><a href="./produkte/../leistungen/.">Produkte' else '' end,
  html, case when page_id % 5 < 3 then concat('&copy; ', cast(2018 + page_id % 9 as string)) else '' end) as html,
 case when page_id % 13 = 0 then 'robots' when page_id % 17 = 0 then 'fetch_failed' else null end as error,
 case when page_id % 3 = 0 then 'HTTP/1.1' else 'HTTP/2' end as http_version,
 case when page_id % 4 = 0 then '{"Strict-Transport-Security":"max-age=1","Server":"cloudflare"}' else '{"Server":"nginx"}' end as headers_json
from pages
""",
    "v_matches": """
select posting_id as match_id, posting_id, case when posting_id % 20 = 0 then null else o_custkey end as company_id,
 case when posting_id % 20 = 0 then 'extern' when posting_id % 3 = 0 then 'region' when posting_id % 3 = 1 then 'exakt' else 'fuzzy_grenzfall' end as match_stufe,
 case when posting_id % 20 = 0 then null else cast(75 + posting_id % 26 as double) end as match_score,
 case posting_id % 4 when 0 then 'hoch' when 1 then 'mittel' when 2 then 'niedrig' else 'unbekannt' end as prio,
 case posting_id % 6 when 0 then 'neu' when 1 then 'gesichtet' when 2 then 'relevant' when 3 then 'irrelevant' when 4 then 'outreach' else 'abgelehnt' end as status
from v_postings join orders on o_orderkey = posting_id where posting_id % 5 = 0
""",
    "v_signals": """
select d.doc_id as signal_id, cast(floor(d.doc_id / 5) as bigint) as company_id, case d.doc_id % 4 when 0 then 'nachfolge' when 1 then 'familienunternehmen' when 2 then '' else 'digitalisierung' end as signal_type,
 case when d.doc_id % 11 = 0 then '' when d.doc_id % 5 = 0 then concat('"', substring(b.text, 3, 60), '."') when d.doc_id % 5 = 1 then concat(substring(b.text, 1, 30), ' made up ') else substring(b.text, 4 + d.doc_id % 50, 80) end as zitat, case when d.doc_id % 7 = 0 then null else concat('https://x.example/', cast(d.doc_id as string)) end as url, b.item_id
from documents d join (select count(*) as n from benchmark) k on true join benchmark b on b.item_id = d.doc_id % k.n
""",
    "v_reviews": """
select c_custkey as company_id, cast(c_custkey % 3 + 1 as int) as wave, case c_custkey % 4 when 0 then 'lead' when 1 then 'uninteressant' else null end as decision, c_custkey % 10 = 2 as selected, case when c_custkey % 9 = 0 then 'note' else '' end as note_self from customer
""",
}


#: Joins of views whose sides grow: their files are small and their rows are not, so none is broadcast.
MERGED = {"v_postings": "c, p", "v_matches": "orders"}


def needed(name: str) -> list[str]:
    """The view and those that it reads, in order."""
    seen = {name}
    for view in reversed(VIEWS):
        if view in seen:
            seen |= {other for other in VIEWS if other != view and other in VIEWS[view]}
    return [v for v in VIEWS if v in seen]


def chain(*names: str) -> str:
    """``with`` clauses of the views, for an oracle over registered tables."""
    views = dict.fromkeys(v for name in names for v in needed(name))
    return "with " + ",\n".join(f"{v} as ({VIEWS[v]})" for v in VIEWS if v in views)


def hinted(view: str) -> str:
    return VIEWS[view].replace("select", f"select /*+ merge({MERGED[view]}) */", 1) if view in MERGED else VIEWS[view]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the Parquet tables of ``sf_dir``; only the columns that are used are read."""
    views = needed(name)
    tables = [t for t in BASE if any(f" {t}" in VIEWS[v] for v in views)]
    clauses = [f"{t} as (select * from parquet.`{sf_dir}/{t}.parquet`)" for t in tables] + [f"{v} as ({hinted(v)})" for v in views]
    return spark.sql(f"with {', '.join(clauses)} select * from {name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
