"""Queries on import and cleansing (A7, C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import importing, keyed
from ..operators.keyed_table import KeyedTable
from ..sources.fixtures import fixture
from ..sources.io import scratch_folder
from .common import Registry, sql_legacy, sql_norm_ws, sql_number, sql_wz2, sql_wz_code

R = Registry()
c = F.col
YEAR = 2024

COMPANY_KEY = f"{sql_norm_ws('name')} || '|' || trim(coalesce(plz, ''))"
PERSON_KEY = f"{sql_norm_ws('firma')} || '|' || trim(coalesce(plz, ''))"
BIRTH = r"case when regexp_full_match(substr(trim(coalesce(gf_geburtsdatum, '')), 1, 4), '\d{4}') then nullif(cast(substr(trim(gf_geburtsdatum), 1, 4) as int), 0) end"


@R.add(
    "a7_upsert_overwrite",
    """with e as (select id, name, plz, cast(id * 2 as bigint) as seen from v_companies where id % 3 <> 0), i as (select id, upper(name) as name, case when id % 5 = 0 then null else 'x' end as note from v_companies where id % 2 = 0)
    select id, case when i.id is not null then i.name else e.name end as name, e.plz, e.seen, i.note from e full join i using (id)""",
    ("v_companies",),
)
def upsert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "v_companies")
    existing = df.filter("id % 3 <> 0").select("id", "name", "plz", (c("id") * 2).cast("long").alias("seen"))
    incoming = df.filter("id % 2 = 0").select("id", F.upper("name").alias("name"), F.when(c("id") % 5 != 0, "x").alias("note"))
    return keyed.upsert(existing, incoming, ["id"])


@R.add(
    "a7_keyed_table",
    """with e as (select id, name, plz, cast(id * 2 as bigint) as seen from v_companies where id % 3 <> 0), i as (select id, upper(name) as name from v_companies where id % 40 = 0)
    select id, case when i.id is not null then i.name else e.name end as name, e.plz, e.seen from e full join i using (id)""",
    ("v_companies",),
)
def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table into which a batch is merged, and then merged again."""
    df = fixture(spark, sf_dir, "v_companies")
    stored = KeyedTable(spark, scratch_folder(spark, "companies"), ("id",), 32)
    stored.create(df.filter("id % 3 <> 0").select("id", "name", "plz", (c("id") * 2).cast("long").alias("seen")))
    for _ in range(2):
        stored.merge(df.filter("id % 40 = 0").select("id", F.upper("name").alias("name")), 0, lambda old, new: keyed.upsert(old, new, ["id"]))
    return stored.rows()


@R.add(
    "a7_upsert_ignore",
    """with e as (select id, name from v_companies where id % 3 <> 0), i as (select id, upper(name) as name from v_companies where id % 2 = 0)
    select * from e union all select * from i where id not in (select id from e)""",
    ("v_companies",),
)
def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "v_companies")
    return keyed.upsert(df.filter("id % 3 <> 0").select("id", "name"), df.filter("id % 2 = 0").select("id", F.upper("name").alias("name")), ["id"], "ignore")


@R.add(
    "c1_merge_exports",
    """with r as (select *, row_number() over (partition by trim(url) order by ord) as k, (trim(rep1) <> '')::int + (trim(rep2) <> '')::int + (trim(rep3) <> '')::int as n from v_export_rows where trim(url) <> '')
    select ord, trim(url) as url, name, case when n > 0 then cast(n as varchar) else '' end as director_count from r where k = 1""",
    ("v_export_rows",),
)
def c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "v_export_rows")
    return importing.merge_exports(rows, "url", "ord", ["rep1", "rep2", "rep3"], "director_count").select("ord", "url", "name", "director_count")


@R.add("c1_merge_counts", "select cast(count(*) as bigint) as total, count(*) filter (url = '') as no_url, count(*) filter (url <> '') - count(distinct nullif(url, '')) as dups from v_export_rows", ("v_export_rows",))
def c1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.merge_counts(fixture(spark, sf_dir, "v_export_rows"), "url")


@R.add(
    "c2_map_company",
    f"""select nullif(trim(url), '') as source_url, nullif(trim(name), '') as name, cast(round_even({sql_number('bilanz_raw')}, 0) as int) as whole, {sql_number('bilanz_raw')} as balance,
      array_to_string(list_filter([trim(rep1), trim(rep2), trim(rep3)], lambda p: p <> ''), ';') as people from v_export_rows""",
    ("v_export_rows",),
)
def c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "v_export_rows")
    mapped = importing.map_company(rows, {"source_url": "url", "name": "name"}, {"whole": "bilanz_raw"}, {"balance": "bilanz_raw"}, {}, ["rep1", "rep2", "rep3"])
    return mapped.select("source_url", "name", "whole", "balance", F.coalesce(F.array_join("ges_vertreter", ";"), F.lit("")).alias("people"))


@R.add(
    "c3_latest_by_key",
    "select ord, url, name from (select *, row_number() over (partition by url order by ord desc) as k from v_export_rows where url <> '' and name <> '') where k = 1",
    ("v_export_rows",),
)
def c3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.latest_by_key(fixture(spark, sf_dir, "v_export_rows"), "url", "name", "ord").select("ord", "url", "name")


@R.add(
    "c3_skipped_rows",
    """select count(*) as n_read, count(*) filter (url = '' or name = '') as skipped, count(*) filter (url <> '' and name <> '') - count(distinct url) filter (url <> '' and name <> '') as replaced from v_export_rows""",
    ("v_export_rows",),
)
def c3_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.skipped_rows(fixture(spark, sf_dir, "v_export_rows"), "url", "name")


HOLDING = f"""case when starts_with({sql_wz_code('branche_wz')}, '68') or starts_with({sql_wz_code('branche_wz')}, '64.20') or starts_with({sql_wz_code('branche_wz')}, '70.10') then 'wz_' || {sql_wz_code('branche_wz')}
  when bilanzsumme_eur > 1000000 and (umsatz_eur is null or umsatz_eur < bilanzsumme_eur * 0.05::double) then 'bilanz_umsatz_implausibel' end"""


def with_holding(companies: DataFrame) -> DataFrame:
    return companies.withColumn("holding_reason", importing.holding_reason(c("branche_wz"), c("bilanzsumme_eur"), c("umsatz_eur")))


@R.add("c4_holding_flag", f"select id, {HOLDING} is not null as holding_flag, {HOLDING} as holding_reason from v_companies", ("v_companies",))
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_holding(fixture(spark, sf_dir, "v_companies"))
    return df.select("id", c("holding_reason").isNotNull().alias("holding_flag"), "holding_reason")


DUPS = f"""n as (select *, {sql_norm_ws('strasse')} as s, {sql_norm_ws('plz')} as p, {sql_norm_ws('ort')} as o, {sql_norm_ws('vertreter_1')} as v from v_companies),
 dups as (select id, case when s <> '' and v <> '' then nullif(first_value(id) over (partition by s, p, o, v order by coalesce(umsatz_eur, 0) desc, coalesce(bilanzsumme_eur, 0) desc, id), id) end as dup_of from n)"""


@R.add("c5_mark_duplicates", f"with {DUPS} select id, dup_of from dups", ("v_companies",))
def c5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.mark_duplicates(fixture(spark, sf_dir, "v_companies")).select("id", "dup_of")


@R.add(
    "c6_enrich_directors",
    f"""with d as (select {PERSON_KEY} as key, {BIRTH} as y, ord, job_key from v_persons where ist_gf = '1'),
    g as (select key, count(*) as n, min(y) as y, arg_min(job_key, (y, ord)) filter (y is not null) as f from d group by key)
    select id, coalesce(g.y, gf_geburtsjahr) as gf_geburtsjahr, 2024 - g.y as gf_alter, case when g.y is not null then 'register/' || substr(g.f, 1, 10) end as gf_quelle, coalesce(g.n, anzahl_gf) as anzahl_gf
    from v_companies left join g on g.key = {COMPANY_KEY}""",
    ("v_persons",),
)
def c6(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = importing.enrich_directors(fixture(spark, sf_dir, "v_companies"), fixture(spark, sf_dir, "v_persons"), YEAR, "ord", c("job_key"))
    return df.select("id", "gf_geburtsjahr", "gf_alter", "gf_quelle", "anzahl_gf")


@R.add(
    "c7_company_size",
    f"""with s as (select {COMPANY_KEY} as key, max(coalesce(umsatz_eur, bilanzsumme_eur)) as size from v_companies group by 1 having size is not null)
    select ord, size from v_persons join s on s.key = {PERSON_KEY}""",
    ("v_persons",),
)
def c7(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = fixture(spark, sf_dir, "v_persons").select("ord", c("firma").alias("name"), "plz")
    return importing.company_size(fixture(spark, sf_dir, "v_companies"), jobs).select("ord", "size")


HANDOVER = f"""hp as (select {PERSON_KEY} as key, lower(trim(gf_nachname)) as surname, {BIRTH} as y from v_persons where ist_gf = '1' and trim(coalesce(gf_nachname, '')) <> ''),
 hf as (select key, surname, count(*) >= 2 as several, coalesce(bool_or(2024 - y < 50), false) as young from hp group by 1, 2), handover as (select key, bool_or(several and young) as handover from hf group by key)"""


@R.add("c8_handover_flag", f"with {HANDOVER} select * from handover", ("v_persons",))
def c8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.handover_flag(fixture(spark, sf_dir, "v_persons"), YEAR)


@R.add(
    "c9_oldest_director",
    f"""with p as (select {sql_legacy('firma')} as key, 2024 - ({BIRTH}) as age, ord, gf_vorname, gf_nachname from v_persons where ist_gf = '1')
    select key, max(age) as age, arg_max(trim(gf_vorname), (age, -ord)) as first, arg_max(trim(gf_nachname), (age, -ord)) as last, '' as title from p where age is not null group by key""",
    ("v_persons",),
)
def c9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import year_of

    return importing.oldest_director(fixture(spark, sf_dir, "v_persons"), "ord", F.lit(YEAR) - year_of(c("gf_geburtsdatum")))


@R.add(
    "c10_persons_by_company",
    f"""with p as (select {PERSON_KEY} as key, 2024 - ({BIRTH}) as age, ord, trim(gf_vorname || ' ' || gf_nachname) as name, ist_gf = '1' as d from v_persons)
    select key, string_agg(name || '/' || coalesce(cast(age as varchar), '?') || '/' || case when d then 'true' else 'false' end, ';' order by -coalesce(age, -1), ord) as people from p group by key""",
    ("v_persons",),
)
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = importing.persons_by_company(fixture(spark, sf_dir, "v_persons"), YEAR, "ord")
    shown = F.transform("people", lambda p: F.concat(p["name"], F.lit("/"), F.coalesce(p["age"].cast("string"), F.lit("?")), F.lit("/"), p["is_director"].cast("string")))
    return people.select("key", F.array_join(shown, ";").alias("people"))


FILES = f"""jf as (select job_key, max(job_key || '+AD-2024' || lpad(cast(ord % 13 as varchar), 2, '0') || '.pdf') as name from v_persons where ord % 3 <> 1 group by 1),
    rf as (select key, arg_min(name, ord) as file from (select {PERSON_KEY} as key, ord, name from v_persons join jf using (job_key)) group by key)"""


def register_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = fixture(spark, sf_dir, "v_persons")
    files = persons.filter("ord % 3 <> 1").select(F.concat("job_key", F.lit("+AD-2024"), F.lpad((c("ord") % 13).cast("string"), 2, "0"), F.lit(".pdf")).alias("name"))
    return importing.latest_file_per_key(files, persons, "ord")


@R.add("c11_latest_file_per_key", f"with {FILES} select key, file from rf", ("v_persons",))
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register_files(spark, sf_dir)


def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = F.when(c("id") % 8 != 0, F.concat(F.lit("http://x"), c("id").cast("string")))
    return with_holding(importing.mark_duplicates(fixture(spark, sf_dir, "v_companies").withColumn("website", site)))


REPORTED = f"{DUPS}, reported as (select v_companies.*, dup_of, {HOLDING} as holding_reason from v_companies join dups using (id))"


@R.add(
    "c12_import_report",
    f"""with {REPORTED} select count(*) as n, count(holding_reason) as holding, count(dup_of) as dup, count(*) filter (id % 8 <> 0) as with_website, count(bilanzsumme_eur) as with_balance, count(mitarbeiterzahl) as with_staff,
      count(gf_geburtsjahr) as with_birth_year, count(*) filter (2024 - gf_geburtsjahr >= 58) as from_58 from reported""",
    ("v_companies",),
)
def c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.import_report(reported(spark, sf_dir), YEAR)


@R.add(
    "c12_report_counts",
    f"""with {REPORTED} select 'reason' as kind, substr(holding_reason, 1, 6) as value, count(*) as n from reported where holding_reason is not null group by 2
    union all select 'priority', cast(coalesce(cast(trunc(prioritaets_score) as int), -1) as varchar), count(*) from reported group by 2
    union all (select 'industry', {sql_wz2('branche_wz')} as v, count(*) as n from reported where v <> '' group by v order by n desc, v limit 8)""",
    ("v_companies",),
)
def c12_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importing.report_counts(reported(spark, sf_dir))
