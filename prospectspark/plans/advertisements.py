"""Queries on the multi-source funnel (D)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import ads
from ..sources.fixtures import fixture, table
from .common import Registry, sql_any, sql_first, sql_norm_posting

R = Registry()
c = F.col


def j(*keys: str) -> str:
    """The first truthy field of payload."""
    return "coalesce(" + ", ".join(f"case when json_extract_string(payload, '$.{k}') not in ('', '0', '0.0', 'false') then json_extract_string(payload, '$.{k}') end" for k in keys) + ")"


UNIFIED = f"""u as (select id, source, {j('company', 'companyName', 'employer')} as company, {j('title', 'positionName', 'jobTitle')} as title,
  case source when 'stepstone' then {j('city', 'location')} else {j('location')} end as location,
  case source when 'indeed' then {j('description', 'descriptionText')} when 'stepstone' then {j('descriptionText', 'description', 'descriptionMarkdown', 'summary')} else {j('description_full', 'description_snippet')} end as description,
  case source when 'indeed' then strftime(make_timestamp(try_cast({j('datePosted')} as bigint) * 1000), '%Y-%m-%d') when 'stepstone' then {j('publishDate', 'publishDateISO', 'postedDate')} else {j('posted_at')} end as posted,
  case source when 'arbeitsagentur' then nullif(trim(concat_ws(' ', {j('contact_salutation')}, {j('contact_firstname')}, {j('contact_lastname')})), '') end as contact,
  coalesce(case source when 'indeed' then {j('isRemote')} when 'arbeitsagentur' then {j('remote_option')} end is not null, false) as remote_hint from v_raw_jobs)"""


@R.add("d1_unify_job_sources", f"with {UNIFIED} select id, source, company, title, location, description, posted, contact, remote_hint from u", ("v_raw_jobs",))
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.unify_job_sources(fixture(spark, sf_dir, "v_raw_jobs")).select("id", "source", "company", "title", "location", "description", "posted", "contact", "remote_hint")


@R.add(
    "d2_external_id",
    f"select id, source, case source when 'arbeitsagentur' then {j('id', 'refnr', 'source_url')} else {j('jobId', 'id')} end as external_id from v_raw_jobs",
    ("v_raw_jobs",),
)
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = fixture(spark, sf_dir, "v_raw_jobs").select("id", "source", F.try_parse_json("payload").alias("doc"))
    return parsed.select("id", "source", ads.external_id(c("source"), c("doc")).alias("external_id"))


KEYED = f"k as (select *, {sql_norm_posting('trim(company)')} || '|' || {sql_norm_posting('trim(title)')} as dedupe_key from u where trim(coalesce(company, '')) <> '' and trim(coalesce(title, '')) <> '')"


def stored_keys(mapped: DataFrame) -> DataFrame:
    return mapped.filter("id % 97 = 0").select(ads.lead_key(c("company"), c("title")).alias("dedupe_key")).distinct()


@R.add(
    "d3_dedupe_leads",
    f"""with {UNIFIED}, {KEYED}, n as (select *, row_number() over (partition by dedupe_key order by id) as r from k where dedupe_key not in (select dedupe_key from k where id % 97 = 0))
    select id, dedupe_key from n where r = 1""",
    ("v_raw_jobs",),
)
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = ads.unify_job_sources(fixture(spark, sf_dir, "v_raw_jobs"))
    return ads.dedupe_leads(mapped, stored_keys(mapped), "id").select("id", "dedupe_key")


def _city(where: str) -> str:
    def first(cities):
        fold = lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower()
        return "coalesce(" + ", ".join(f"case when contains({where}, '{fold(x)}') then '{x}' end" for x in cities) + ")"

    return f"{first(config.EXCLUDED_CITIES)} as out_city, {first(config.TARGET_CITIES)} as in_city"


@R.add(
    "d4_detect_city",
    f"""with {UNIFIED}, l as (select id, {sql_norm_posting("case id % 5 when 0 then 'Marburg (Hessen)' when 1 then 'Neu-Ulm' when 2 then 'MÜNCHEN' else location end")} as w from u), m as (select id, {_city('w')} from l)
    select id, out_city is null and in_city is not null as in_target, coalesce(out_city, in_city) as city from m""",
    ("v_raw_jobs",),
)
def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = ads.unify_job_sources(fixture(spark, sf_dir, "v_raw_jobs"))
    where = F.when(c("id") % 5 == 0, "Marburg (Hessen)").when(c("id") % 5 == 1, "Neu-Ulm").when(c("id") % 5 == 2, "MÜNCHEN").otherwise(c("location"))
    return mapped.select("id", ads.detect_city(where).alias("where")).select("id", "where.in_target", "where.city")


TAGS = f"""{sql_first("coalesce(title, '') || ' ' || coalesce(description, '')", config.ACCOUNTING_TERMS)} as excluded,
 remote_hint or {sql_any("concat_ws(' ', title, description, location)", config.REMOTE_HINTS)} as remote"""


@R.add("d5_tags", f"with {UNIFIED} select id, {TAGS} from u", ("v_raw_jobs",))
def d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = ads.unify_job_sources(fixture(spark, sf_dir, "v_raw_jobs"))
    return mapped.select("id", ads.excluded_term(c("title"), c("description")).alias("excluded"), ads.is_remote(c("remote_hint"), c("title"), c("description"), c("location")).alias("remote"))


@R.add(
    "d6_export_leads",
    f"""with {UNIFIED}, t as (select *, {TAGS}, {sql_norm_posting('location')} as w from u), m as (select *, {_city('w')} from t)
    select id, company, title, coalesce(out_city, in_city) as city, remote from m where out_city is null and in_city is not null and excluded is null""",
    ("v_raw_jobs",),
)
def d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = ads.build_leads(ads.unify_job_sources(fixture(spark, sf_dir, "v_raw_jobs")))
    columns = ["id", "company", "title", "city", "remote"]
    return ads.export_leads(leads.select(*columns, "in_target", "excluded")).select(columns)


@R.add(
    "d7_extract_contacts",
    r"""with h as (select doc_id, case when length(text) >= 30 then text end as h, case when doc_id % 10 = 0 then 'known@example.org' else '' end as mail from documents)
    select doc_id, coalesce(nullif(mail, ''), nullif(regexp_extract(h, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), '')) as email, nullif(regexp_extract(h, '\+\d[\d /()-]{6,}\d'), '') as phone from h""",
)
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(c("doc_id") % 10 == 0, "known@example.org").otherwise("").alias("email"), F.lit(None).cast("string").alias("phone"))
    return ads.extract_contacts(docs, "text", "email", "phone").select("doc_id", "email", "phone")


@R.add("d8_dates_descriptions", f"with {UNIFIED} select id, case when length(posted) >= 10 then substr(posted, 1, 10) end as posted_date, substr(coalesce(description, ''), 1, 5000) as description from u", ("v_raw_jobs",))
def d8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.build_leads(ads.unify_job_sources(fixture(spark, sf_dir, "v_raw_jobs"))).select("id", "posted_date", "description")
