"""Queries on the scalar functions (B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import helpers, numbers, text
from ..sources.fixtures import fixture
from .common import Registry, sql_any, sql_first, sql_legacy, sql_norm_company, sql_norm_posting, sql_norm_text, sql_norm_ws, sql_number, sql_one_decimal, sql_ratio, sql_wz2, sql_wz_code

R = Registry()
c = F.col


@R.add("b1_norm_ws", f"select id, {sql_norm_ws('name')} as name_norm, {sql_norm_ws('strasse')} as street_norm from v_companies", ("v_companies",))
def b1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", text.norm_ws(c("name")).alias("name_norm"), text.norm_ws(c("strasse")).alias("street_norm"))


@R.add("b2_norm_text", f"select posting_id, {sql_norm_text('titel')} as title_norm from v_postings", ("v_postings",))
def b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_postings").select("posting_id", text.norm_text(c("titel")).alias("title_norm"))


@R.add("b3_norm_company", f"select id, {sql_norm_company('name')} as company_norm from v_companies", ("v_companies",))
def b3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", text.norm_company(c("name")).alias("company_norm"))


@R.add("b4_norm_posting", f"select posting_id, {sql_norm_posting('arbeitgeber')} as employer_norm, {sql_norm_posting('titel')} as title_norm from v_postings", ("v_postings",))
def b4(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "v_postings")
    return df.select("posting_id", text.norm_posting(c("arbeitgeber")).alias("employer_norm"), text.norm_posting(c("titel")).alias("title_norm"))


@R.add("b5_norm_company_legacy", f"select id, {sql_legacy('name')} as legacy_key from v_companies", ("v_companies",))
def b5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", text.norm_company_legacy(c("name")).alias("legacy_key"))


@R.add("b6_company_key", f"select id, {sql_norm_ws('name')} || '|' || trim(coalesce(plz, '')) as company_key from v_companies", ("v_companies",))
def b6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", text.company_key(c("name"), c("plz")).alias("company_key"))


@R.add("b7_repost_key", f"select {sql_norm_company('arbeitgeber')} as employer_key, {sql_norm_text('titel')} as title_key, count(*) as n from v_postings group by 1, 2", ("v_postings",))
def b7(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = text.repost_key(c("arbeitgeber"), c("titel"))
    df = fixture(spark, sf_dir, "v_postings").select(key.alias("k")).select(c("k.employer").alias("employer_key"), c("k.title").alias("title_key"))
    return df.groupBy("employer_key", "title_key").agg(F.count("*").alias("n"))


@R.add("b8_parse_german_number", f"select ord, {sql_number('bilanz_raw')} as value from v_export_rows", ("v_export_rows",))
def b8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_export_rows").select("ord", numbers.parse_german_number(c("bilanz_raw")).alias("value"))


@R.add(
    "b9_parse_int_bool",
    f"select ord, cast(round_even({sql_number('bilanz_raw')}, 0) as int) as whole, case ord % 4 when 0 then 'Ja ' when 1 then 'x' when 2 then 'nein' end in ('Ja ', 'x') as flag from v_export_rows",
    ("v_export_rows",),
)
def b9(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(c("ord") % 4 == 0, "Ja ").when(c("ord") % 4 == 1, "x").when(c("ord") % 4 == 2, "nein")
    return fixture(spark, sf_dir, "v_export_rows").select("ord", numbers.parse_german_int(c("bilanz_raw")).alias("whole"), numbers.parse_bool(word).alias("flag"))


@R.add("b10_wz_codes", f"select id, {sql_wz_code('branche_wz')} as code, {sql_wz2('branche_wz')} as code2 from v_companies", ("v_companies",))
def b10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", text.wz_code(c("branche_wz")).alias("code"), text.wz2(c("branche_wz")).alias("code2"))


@R.add(
    "b11_hosts",
    """with h as (select page_id, lower(trim(coalesce(nullif(regexp_extract(url, '//([^/?#]*)', 1), ''), regexp_extract(url, '//[^/?#]*([^?#]*)', 1)), '/')) as host from v_pages)
    select page_id, host, regexp_replace(host, '^www\\.', '') as site, host = '' or regexp_replace(host, '^www\\.', '') = 'example.org' as own from h""",
    ("v_pages",),
)
def b11(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = text.normalize_host(c("url"))
    return fixture(spark, sf_dir, "v_pages").select("page_id", host.alias("host"), text.registrable(host).alias("site"), text.same_site(c("url"), F.lit("www.example.org")).alias("own"))


@R.add(
    "b12_years",
    """select ord, case when regexp_full_match(substr(gf_geburtsdatum, 1, 4), '\\d{4}') then nullif(cast(substr(gf_geburtsdatum, 1, 4) as int), 0) end as birth_year,
    try_cast(nullif(regexp_extract(job_key || ' 20' || lpad(cast(ord % 100 as varchar), 2, '0'), '(20\\d{2})', 1), '') as int) as text_year from v_persons""",
    ("v_persons",),
)
def b12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.concat(c("job_key"), F.lit(" 20"), F.lpad((c("ord") % 100).cast("string"), 2, "0"))
    return fixture(spark, sf_dir, "v_persons").select("ord", text.year_of(c("gf_geburtsdatum")).alias("birth_year"), text.year_in_text(words).alias("text_year"))


@R.add("b13_to_thousand_eur", "select id, cast(round_even(bilanzsumme_eur / 1000, 0) as bigint) as balance_k from v_companies", ("v_companies",))
def b13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", numbers.to_thousand_eur(c("bilanzsumme_eur")).alias("balance_k"))


@R.add(
    "b14_dates_phones_slugs",
    r"""select posting_id, strftime(veroeffentlicht_am, '%d.%m.%Y') as day, '+49' || posting_id as phone,
    substr(trim(regexp_replace(lower(arbeitgeber), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40) as slug from v_postings""",
    ("v_postings",),
)
def b14(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone = F.concat(F.lit("(+49) / "), c("posting_id").cast("string"))
    return fixture(spark, sf_dir, "v_postings").select("posting_id", text.format_de_date(c("veroeffentlicht_am").cast("string")).alias("day"), text.phone_digits(phone).alias("phone"), text.slug(c("arbeitgeber")).alias("slug"))


_LABELS = ", ".join(f"'{k}': '{v}'" for k, v in config.CLUSTER_LABELS.items())


@R.add(
    "b15_short_industry",
    rf"""with t as (select id, case when id % 9 = 0 then '' else trim(regexp_replace(trim(branche_wz || case when id % 2 = 0 then ' und sonstige Dienstleistungen aller Art' else '' end), '^\s*\d+(?:\.\d+)*\s*', '')) end as s,
      case id % 3 when 0 then 'produzierend' when 1 then 'handel_b2c' else 'rest' end as k from v_companies),
    u as (select *, substr(s, 1, 44) as h from t)
    select id, case when s = '' then coalesce(map {{{_LABELS}}}[k], replace(k, '_', ' ')) when length(s) <= 44 then s
      else regexp_replace(coalesce(nullif(regexp_extract(h, '^(.+) [^ ]*$', 1), ''), h), '[ ,-]+$', '') || '…' end as label from u""",
    ("v_companies",),
)
def b15(spark: SparkSession, sf_dir: str) -> DataFrame:
    wz = F.when(c("id") % 9 == 0, " ").otherwise(F.concat("branche_wz", F.when(c("id") % 2 == 0, " und sonstige Dienstleistungen aller Art").otherwise("")))
    cluster = F.when(c("id") % 3 == 0, "produzierend").when(c("id") % 3 == 1, "handel_b2c").otherwise("rest")
    return fixture(spark, sf_dir, "v_companies").select("id", text.short_industry(wz, cluster).alias("label"))


@R.add(
    "b16_age_priority",
    "select id, case when gf_geburtsjahr is null then 'unbekannt' when 2024 - gf_geburtsjahr >= 58 then 'hoch' when 2024 - gf_geburtsjahr >= 50 then 'mittel' else 'niedrig' end as priority from v_companies",
    ("v_companies",),
)
def b16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_companies").select("id", text.age_priority(F.lit(2024) - c("gf_geburtsjahr")).alias("priority"))


@R.add(
    "b17_split_title",
    """with t as (select ord, case ord % 4 when 0 then 'Dr. ' when 1 then 'Dipl.-Ing. ' when 2 then '' else 'Prof. Dr. ' end || gf_vorname as v, gf_nachname as n from v_persons)
    select ord, trim(replace(replace(replace(replace(v, 'Prof.', ''), 'Dr.', ''), 'Dipl.-Ing.', ''), 'Ing.', '')) as first_name, n as last_name,
      case ord % 4 when 0 then 'Dr.' when 1 then 'Dipl.-Ing. Dipl. Ing.' when 2 then '' else 'Prof. Dr.' end as title from t""",
    ("v_persons",),
)
def b17(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(c("ord") % 4 == 0, "Dr. ").when(c("ord") % 4 == 1, "Dipl.-Ing. ").when(c("ord") % 4 == 2, "").otherwise("Prof. Dr. ")
    s = fixture(spark, sf_dir, "v_persons").select("ord", text.split_title(F.concat(prefix, "gf_vorname"), c("gf_nachname")).alias("s"))
    return s.select("ord", c("s.first").alias("first_name"), c("s.last").alias("last_name"), "s.title")


_TERMS = ("Leiter", "controlling", "CFO")


@R.add("b18_terms", f"select posting_id, {sql_any('titel', _TERMS)} as hit, {sql_first('titel', _TERMS)} as first_hit from v_postings", ("v_postings",))
def b18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "v_postings").select("posting_id", text.any_term(c("titel"), _TERMS).alias("hit"), text.first_term(c("titel"), _TERMS).alias("first_hit"))


_PAIRS = f"p as (select distinct {sql_norm_company('arbeitgeber')} as a, {sql_norm_company('c.name')} as b from v_postings p join v_companies c on p.plz = c.plz)"


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised employer and company names that stand in one postal code."""
    left = fixture(spark, sf_dir, "v_postings").select("plz", text.norm_company(c("arbeitgeber")).alias("a")).distinct()
    right = fixture(spark, sf_dir, "v_companies").select("plz", text.norm_company(c("name")).alias("b")).distinct()
    return left.join(right, "plz").select("a", "b").distinct()


@R.add("b19_token_set_ratio", f"with {_PAIRS}, {sql_ratio('p')} select p.a, p.b, {sql_one_decimal('score')} as ratio from p join ratio on p.a is not distinct from ratio.a and p.b is not distinct from ratio.b", ("v_postings",))
def b19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_pairs(spark, sf_dir).select("a", "b", helpers.round_score(helpers.token_set_ratio("a", "b")).alias("ratio"))


@R.add(
    "b20_proper_token_subset",
    f"""with {_PAIRS}, s as (select a, b, list_distinct(string_split(a, ' ')) as x, list_distinct(string_split(b, ' ')) as y from p)
    select a, b, (len(list_intersect(x, y)) = len(x) or len(list_intersect(x, y)) = len(y)) and len(x) <> len(y) as subset from s""",
    ("v_postings",),
)
def b20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_pairs(spark, sf_dir).select("a", "b", text.is_proper_token_subset(c("a"), c("b")).alias("subset"))


@R.add(
    "b21_strip_place_tokens",
    f"""with n as (select id, {sql_norm_company('name')} as n, string_split({sql_norm_text('ort')}, ' ') as o from v_companies)
    select id, coalesce(nullif(array_to_string(list_filter(string_split(n, ' '), lambda t: not list_contains(o, t)), ' '), ''), n) as bare from n""",
    ("v_companies",),
)
def b21(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixture(spark, sf_dir, "v_companies").select("id", text.norm_company(c("name")).alias("name"), text.norm_text(c("ort")).alias("place"))
    return df.select("id", text.strip_place_tokens(c("name"), c("place")).alias("bare"))
