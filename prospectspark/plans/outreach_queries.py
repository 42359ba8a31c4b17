"""Queries on curation and outreach (I), integrity (J) and streams (K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import evidence, importing, integrity, outreach
from ..operators.keyed_table import KeyedTable
from ..sources.fixtures import fixture, table
from ..sources.io import scratch_folder
from ..streaming import lifecycle, streams
from .common import Registry, sql_legacy
from .imports import BIRTH, COMPANY_KEY, FILES, PERSON_KEY, register_files, with_holding
from .scores import SCORES, VIEWS, scores

R = Registry()
c = F.col
TODAY = "2024-01-20"

_CODE = r"regexp_extract(trim(coalesce(branche_wz, '')), '^(\d\d)', 1)"
_AFFINITY = "case " + " ".join(f"when {_CODE} in ({', '.join(repr(x) for x in codes)}) then '{tier}'" for tier, codes in config.AFFINITY.items()) + " else 'mittel' end"
_CONSULT = f"{_CODE} in ({', '.join(repr(x) for x in config.CONSULTANT_WZ)})"


@R.add("i1_affinity", f"select id, {_AFFINITY} as affinity, {_CONSULT} as consultant from v_companies", ("v_companies",))
def i1(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = outreach.industry_code(c("branche_wz"))
    return fixture(spark, sf_dir, "v_companies").select("id", outreach.affinity(code).alias("affinity"), outreach.is_consultant(code).alias("consultant"))


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = with_holding(fixture(spark, sf_dir, "v_companies")).withColumn("dup_of", F.lit(None).cast("long")).withColumn("excluded", c("id") % 31 == 0)
    firms = firms.withColumn("register_id", F.when(c("id") % 4 != 0, F.concat(F.lit("HRB "), c("id").cast("string")))).withColumn("hr_amtsgericht", c("ort"))
    persons = fixture(spark, sf_dir, "v_persons")
    handover, people = importing.handover_flag(persons, 2024), importing.persons_by_company(persons, 2024, "ord")
    dossiers = evidence.parse_dossiers(fixture(spark, sf_dir, "v_dossiers"))
    return outreach.curation_frame(scores(spark, sf_dir), firms, fixture(spark, sf_dir, "v_signals"), handover, dossiers, people, register_files(spark, sf_dir))


EVIDENCE = """e0 as (select *, coalesce(nullif(signal_type, ''), 'sonstiges') as st from v_signals), e1 as (select *, row_number() over (partition by company_id, st order by signal_id) as k from e0),
ev as (select company_id, cast(count(*) as int) as n_evidence, string_agg(st || '|' || trim(coalesce(zitat, '')) || '|' || coalesce(url, ''), ';' order by st) as evidence from e1 where k = 1 group by 1)"""
PEOPLE = f"""p0 as (select {PERSON_KEY} as key, 2024 - ({BIRTH}) as age, ord, trim(gf_vorname || ' ' || gf_nachname) as person from v_persons),
pp as (select key, string_agg(person || '/' || coalesce(cast(age as varchar), '?'), ';' order by -coalesce(age, -1), ord) as people from p0 group by key)"""
_REGION = "case regexp_extract(s.plz, '^(\\d\\d)', 1) " + " ".join(f"when '{k}' then '{v}'" for k, v in config.REGION_LABELS.items()) + " else coalesce(nullif(regexp_extract(s.plz, '^(\\d\\d)', 1), ''), '?') end"
_PAIN = "case cluster_branche " + " ".join(f"when '{k}' then '{v}'" for k, v in config.PAIN_POINTS.items()) + " else '' end"
FRAME = rf"""{SCORES}, {EVIDENCE}, {PEOPLE}, {FILES}, frame as (select s.company_id, s.name, s.plz, s.ort, regexp_extract(s.plz, '^(\d\d)', 1) as plz2, {_REGION} as region, {_AFFINITY} as affinity, {_CONSULT} as consultant, cluster_branche as cluster,
  score_klasse as klasse, score_total as score, age as gf_alter, ho as handover, cast(round_even(umsatz_eur / 1000, 0) as bigint) as revenue_k, cast(round_even(bilanzsumme_eur / 1000, 0) as bigint) as balance_k,
  k7 as family, k9 as settled, coalesce(json_extract_string(dossier_json, '$.naechste_generation'), '') as next_generation, coalesce(array_to_string(from_json(json_extract(dossier_json, '$.nachfolge_signale'), '["VARCHAR"]'), '; '), '') as succession_signs,
  coalesce(json_extract_string(dossier_json, '$.geschaeftsmodell'), '') as business_model, cast(json_extract_string(dossier_json, '$.fuehrungsstruktur.kaufmaennische_funktion_besetzt') as boolean) as commercial_role_filled,
  cast(json_extract_string(dossier_json, '$.fuehrungsstruktur.zweite_ebene_sichtbar') as boolean) as second_level, {_PAIN} as pain_point, coalesce(people, '') as people, coalesce(evidence, '') as evidence, coalesce(n_evidence, 0) as n_evidence,
  case when s.company_id % 4 <> 0 then 'HRB ' || s.company_id else '' end as register_id, s.ort as court, rf.file
  from scored s left join ev using (company_id) left join pp on pp.key = {COMPANY_KEY} left join rf on rf.key = {COMPANY_KEY} where holding_reason is null and s.company_id % 31 <> 0)"""


@R.add("i2_curation_frame", f"with {FRAME} select * from frame", (*VIEWS, "v_signals"))
def i2(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = lambda p: F.concat(p["name"], F.lit("/"), F.coalesce(p["age"].cast("string"), F.lit("?")))
    quote = lambda e: F.concat_ws("|", e["signal_type"], e["zitat"], e["url"])
    rows = frame(spark, sf_dir).drop("commercial_jobs", "hooks")  # empty lists in these dossiers
    return rows.withColumn("people", F.array_join(F.transform("people", person), ";")).withColumn("evidence", F.array_join(F.transform("evidence", quote), ";"))


@R.add(
    "i3_first_evidence",
    """with s as (select *, coalesce(nullif(signal_type, ''), 'sonstiges') as t from v_signals), r as (select *, row_number() over (partition by company_id, t order by signal_id) as k from s)
    select company_id, t as signal_type, trim(coalesce(zitat, '')) as zitat, coalesce(url, '') as url from r where k = 1""",
    ("v_signals",),
)
def i3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.first_evidence(fixture(spark, sf_dir, "v_signals"))


@R.add(
    "i4_curation_filter",
    f"""with {FRAME} select company_id, klasse, score, gf_alter from frame left join (select company_id, decision from v_reviews) using (company_id)
    where affinity in ('fern', 'mittel') and not consultant and klasse in ('A', 'B', 'C') and not handover and not settled and (gf_alter >= 50 or gf_alter is null)
      and (balance_k between 1 and 9000 or balance_k is null) and (revenue_k between 500 and 15000 or revenue_k is null) and (contains(lower(name), 'e') or contains(lower(ort), 'e')) and not coalesce(decision in ('lead', 'uninteressant'), false)""",
    (*VIEWS, "v_signals", "v_reviews"),
)
def i4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outreach.curation_filter(
        frame(spark, sf_dir), affinity=("fern", "mittel"), classes=("A", "B", "C"), min_age=50, unknown_age=True, balance_k=(1, 9000), revenue_k=(500, 15_000), search="e", reviews=fixture(spark, sf_dir, "v_reviews"), review_status="offen"
    )
    return rows.select("company_id", "klasse", "score", "gf_alter")


@R.add(
    "i5_merge_reviews",
    """select company_id, wave, decision, selected, note_self from v_reviews where wave <> 2 union all
    select company_id, 2, decision, coalesce(decision = 'lead', false), note_self from (select company_id, decision, note_self from v_reviews where wave <> 3) n where decision is not null or note_self <> ''""",
    ("v_reviews",),
)
def i5(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = fixture(spark, sf_dir, "v_reviews")
    return outreach.merge_reviews(reviews, reviews.filter("wave <> 3"), 2)


@R.add(
    "i5_write_wave",
    """select company_id, wave, decision, selected, note_self from v_reviews where wave <> 2 union all
    select company_id, 2, decision, coalesce(decision = 'lead', false), note_self from (select company_id, decision, note_self from v_reviews where wave <> 3) n where decision is not null or note_self <> ''""",
    ("v_reviews",),
)
def i5_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of which one wave is written anew."""
    reviews, path = fixture(spark, sf_dir, "v_reviews"), f"{scratch(spark)}/reviews"
    reviews.write.partitionBy("wave").parquet(path)
    outreach.write_wave(path, reviews.filter("wave <> 3"), 2)
    return spark.read.parquet(path).select("company_id", "wave", "decision", "selected", "note_self")


@R.add("i6_leads_by_wave", "select distinct wave, company_id from v_reviews where decision = 'lead' or (decision is null and selected)", ("v_reviews",))
def i6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.leads_by_wave(fixture(spark, sf_dir, "v_reviews"))


@R.add(
    "i6_reconcile_letters",
    """with l as (select case when id % 7 = 0 then name || ' x' else name end as name from v_companies where id % 2 = 0),
    j as (select l.name, v.id, v.id in (select company_id from v_reviews where decision = 'lead' or (decision is null and selected)) as lead from l left join v_companies v using (name))
    select case when id is null then 'unmatched' when not lead then 'dropped' else 'lead' end as state, count(*) as n from j group by 1""",
    ("v_reviews", "v_companies"),
)
def i6_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = fixture(spark, sf_dir, "v_companies")
    letters = firms.filter("id % 2 = 0").select(F.when(c("id") % 7 == 0, F.concat("name", F.lit(" x"))).otherwise(c("name")).alias("name"))
    return outreach.reconcile_letters(letters, firms, fixture(spark, sf_dir, "v_reviews"))


@R.add(
    "i7_queue_letters",
    """with e as (select company_id, channel, wave, status from v_outreach), l as (select distinct company_id from v_reviews where decision = 'lead' or (decision is null and selected))
    select * from e union all select company_id, 'letter', 2, 'queued' from l where company_id not in (select company_id from e where channel = 'letter' and wave = 2)""",
    ("v_reviews", "v_outreach"),
)
def i7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.queue_letters(fixture(spark, sf_dir, "v_outreach"), outreach.leads_by_wave(fixture(spark, sf_dir, "v_reviews")), 2)


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = outreach.leads_by_wave(fixture(spark, sf_dir, "v_reviews")).select("company_id").distinct()
    firms = fixture(spark, sf_dir, "v_companies").select(c("id").alias("company_id"), "name", F.when(c("id") % 5 != 0, c("id") % 11).alias("score"))
    return firms.join(chosen, "company_id", "left_semi")


STATE = f"""l as (select id as company_id, name, case when id % 5 <> 0 then id % 11 end as score from v_companies where id in (select company_id from v_reviews where decision = 'lead' or (decision is null and selected))),
 o as (select company_id, arg_max(status, outreach_id) filter (channel = 'letter') as status, arg_max(status, outreach_id) filter (channel = 'email') as mail from v_outreach group by 1),
 k as (select company_id, count(*) as n_calls, bool_or(outcome not in ('nicht_erreicht', 'falsche_nummer')) as reached, arg_max(follow_up_at, (called_at, call_id)) filter (follow_up_at is not null) as follow_up from v_calls group by 1),
 s as (select *, case when status in ('won', 'rejected') then 5 when follow_up < date '{TODAY}' then 0 when follow_up = date '{TODAY}' then 1 when n_calls is null then 2 when status = 'no_response' then 4 else 3 end as priority
   from l left join o using (company_id) left join k using (company_id))"""
CONTACT = ("v_companies", "v_reviews", "v_outreach", "v_calls")


@R.add("i8_funnel_kpis", f"""with {STATE} select count(*) as leads, count(status) as letters, count(*) filter (status <> 'queued') as sent, count(*) filter (mail = 'sent') as mails, count(n_calls) as called, count(*) filter (reached) as reached,
      count(*) filter (follow_up <= date '{TODAY}' and coalesce(status not in ('won', 'rejected'), true)) as due, count(*) filter (status = 'won') as won, count(*) filter (status = 'rejected') as lost,
      count(*) filter (coalesce(status not in ('won', 'rejected'), true)) as open from s""", CONTACT)
def i8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.funnel_kpis(leads(spark, sf_dir), fixture(spark, sf_dir, "v_outreach"), fixture(spark, sf_dir, "v_calls"), TODAY)


@R.add("i9_work_list", f"with {STATE} select company_id, priority, follow_up, coalesce(n_calls, 0) as n_calls from s where priority < 5", CONTACT)
def i9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outreach.work_list(leads(spark, sf_dir), fixture(spark, sf_dir, "v_outreach"), fixture(spark, sf_dir, "v_calls"), TODAY)
    return rows.select("company_id", "priority", "follow_up", F.coalesce("n_calls", F.lit(0)).alias("n_calls"))


for _name in ("i8_funnel_kpis", "i9_work_list"):  # second names of queries that once took every third company
    R.alias(f"{_name}_all", _name)


@R.add(
    "i10_mark_sent",
    """select outreach_id, case when channel = 'letter' and wave = 2 and status = 'queued' then 'sent' else status end as status, case when channel = 'letter' and wave = 2 and status = 'queued' then date '2024-01-05' else sent_at end as sent_at from v_outreach""",
    ("v_outreach",),
)
def i10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.mark_sent(fixture(spark, sf_dir, "v_outreach"), 2, "2024-01-05").select("outreach_id", "status", "sent_at")


@R.add(
    "i10_suggest_disposition",
    "with l as (select company_id, arg_max(outcome, (called_at, call_id)) as o from v_calls group by 1) select company_id, case o when 'termin' then 'won' else 'rejected' end as suggestion from l where o in ('termin', 'kein_interesse')",
    ("v_calls",),
)
def i10_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.suggest_disposition(fixture(spark, sf_dir, "v_calls"))


@R.add(
    "i11_lead_list",
    rf"""with {SCORES} select o.company_id, trim(coalesce(v.name, '')) as firma, trim(regexp_replace(trim(v.branche_wz), '^\s*\d+(?:\.\d+)*\s*', '')) as branche, trim(coalesce(v.ort, '')) as stadt, coalesce(score_total, -1) as score, o.status
    from v_outreach o join v_companies v on v.id = o.company_id left join scored using (company_id) where channel = 'letter' and wave = 1 and status in ('queued', 'sent')""",
    (*VIEWS, "v_outreach"),
)
def i11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.lead_list(fixture(spark, sf_dir, "v_outreach"), fixture(spark, sf_dir, "v_companies"), scores(spark, sf_dir), 1, "letter", ("queued", "sent"), "score")


OVERRIDES = ((1, "ivory", "one"), (2, "GmbH & Co", "two"), (3, "GmbH", "three"))


@R.add(
    "i12_apply_by_substring",
    f"with o(ord, key, value) as (values {', '.join(map(str, OVERRIDES))}) select id, arg_min(value, ord) as value from v_companies join o on contains(name, key) group by id",
    ("v_companies",),
)
def i12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.apply_by_substring(fixture(spark, sf_dir, "v_companies"), spark.createDataFrame(list(OVERRIDES), "ord int, key string, value string"))


@R.add(
    "i12_overrides_from_parts",
    """with o as (select p_partkey as ord, substr(p_name, 1 + p_partkey % 7, 5 + p_partkey % 9) as key, p_brand as value from part where p_partkey % 4 = 0 union all select 1000000000 + p_partkey, substr(p_name, 3, p_partkey % 4), 'short' from part where p_partkey % 499 in (1, 2, 3))
    select id, arg_min(value, ord) as value from v_companies join o on contains(name, key) group by id""",
    ("v_companies",),
)
def i12_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides whose number grows with the table: pieces of a quarter of all names, and some of one to three characters."""
    long_ = table(spark, sf_dir, "part").filter("p_partkey % 4 = 0").selectExpr("p_partkey as ord", "substring(p_name, int(1 + p_partkey % 7), int(5 + p_partkey % 9)) as key", "p_brand as value")
    short = table(spark, sf_dir, "part").filter("p_partkey % 499 in (1, 2, 3)").selectExpr("1000000000 + p_partkey as ord", "substring(p_name, 3, int(p_partkey % 4)) as key", "'short' as value")
    return outreach.apply_by_substring(fixture(spark, sf_dir, "v_companies"), long_.unionByName(short))


@R.add(
    "i13_salutation",
    rf"""with p as (select {sql_legacy('firma')} as key, case when regexp_full_match(substr(gf_geburtsdatum, 1, 4), '\d{{4}}') then 2024 - cast(substr(gf_geburtsdatum, 1, 4) as int) end as age, ord, gf_vorname, gf_nachname from v_persons where ist_gf = '1'),
    d as (select key, max(age) as age, arg_max(trim(gf_vorname), (age, -ord)) as f, arg_max(trim(gf_nachname), (age, -ord)) as l from p where age is not null group by key),
    j as (select id, d.*, case when cast(substr(f, 2) as int) % 3 = 0 then 'm' when cast(substr(f, 2) as int) % 3 = 1 then 'f' end as g from v_companies left join d on d.key = {sql_legacy('name')})
    select id, case when age is null then null when coalesce(g, 'm') = 'm' then 'Herrn' else 'Frau' end as address, coalesce(f || ' ' || l, '') as name_line,
      case when age is null then 'Sehr geehrte Damen und Herren,' when coalesce(g, 'm') = 'm' then 'Sehr geehrter Herr ' || l || ',' else 'Sehr geehrte Frau ' || l || ',' end as salutation,
      concat_ws('; ', case when age is null then 'no director' end, case when age is not null and g is null then 'gender unknown' end, case when age >= 75 then 'very old' end) as flags from j""",
    ("v_persons",),
)
def i13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import year_of

    persons = fixture(spark, sf_dir, "v_persons")
    directors = importing.oldest_director(persons, "ord", F.lit(2024) - year_of(c("gf_geburtsdatum")))
    number = F.substring("gf_vorname", 2, 9).cast("int") % 3
    genders = persons.select(c("gf_vorname").alias("first_name"), F.when(number == 0, "m").when(number == 1, "f").alias("gender")).distinct().filter("gender is not null")
    return outreach.salutation(fixture(spark, sf_dir, "v_companies"), directors, genders)


@R.add(
    "j1_check_constraints",
    """select 'company set' as rule, count(*) filter (company_id is null) as violations from v_matches union all select 'stage known', count(*) filter (match_stufe not in ('exakt', 'region', 'extern')) from v_matches
    union all select 'score or company', count(*) filter (company_id is null and match_score is null) from v_matches
    union all select 'one match a pair', count(*) from (select posting_id % 500 as p, company_id from v_matches where company_id is not null group by all having count(*) > 1)
    union all select 'one new row a company', count(*) from (select company_id from v_matches where status = 'neu' and company_id is not null group by 1 having count(*) > 1)
    union all select 'company exists', count(*) from v_matches where company_id is not null and company_id not in (select id from v_companies where id % 10 <> 0)""",
    ("v_matches", "v_companies"),
)
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = fixture(spark, sf_dir, "v_matches").withColumn("bucket", c("posting_id") % 500)
    rule = integrity.Rule
    return integrity.check_constraints(
        matches,
        [
            rule("company set", "not_null", ["company_id"]), rule("stage known", "enum", ["match_stufe"], ("exakt", "region", "extern")), rule("score or company", "one_of", ["company_id", "match_score"]),
            rule("one match a pair", "unique", ["bucket", "company_id"]), rule("one new row a company", "unique", ["company_id"], where=c("status") == "neu"),
            rule("company exists", "reference", ["company_id"], other=fixture(spark, sf_dir, "v_companies").filter("id % 10 <> 0"), other_key="id"),
        ],
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as sightings of advertisements."""
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.select(F.concat(F.lit("R"), (c("event_id") % 700).cast("string")).alias("refnr"), "ts", "event_id")


def scratch(spark: SparkSession) -> str:
    return scratch_folder(spark, "query")


@R.add("k1_stream_sightings", "select 'R' || (event_id % 700) as refnr, min(ts) as first_seen, max(ts) as last_seen, count(*) as n from events group by 1")
def k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    streams.stream_sightings(event_stream(spark, sf_dir), f"{folder}/table", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("refnr", "first_seen", "last_seen", "n")


@R.add("k1_sightings_by_batches", "select 'R' || (event_id % 700) as refnr, min(ts) as first_seen, max(ts) as last_seen, count(*) as n from events group by 1")
def k1_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in four batches, the second one twice."""
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("R"), (c("event_id") % 700).cast("string")).alias("refnr"), "ts")
    kept = KeyedTable(spark, f"{scratch(spark)}/sightings", ("refnr",), 16)
    for number, part in enumerate((0, 1, 1, 2, 3)):
        kept.merge(streams.sightings(events.filter(c("event_id") % 4 == part)), number - (number > 1), streams.united)
    return kept.rows()


_LIFE = """with l as (select 'R' || (event_id * event_id % 997) as refnr, epoch_us(ts) // 1000 as t from events), g as (select *, case when t > lag(t) over (partition by refnr order by t) + 259200000 then 1 else 0 end as s from l),
 r as (select *, sum(s) over (partition by refnr order by t rows unbounded preceding) as run from g), e as (select refnr, run, min(t) as a, max(t) as b, count(*) as n from r group by 1, 2)"""


@R.add(
    "k1_lifecycle",
    f"""{_LIFE} select refnr, 'appeared' as event, make_timestamp(a * 1000) as at, make_timestamp(a * 1000) as first_seen, make_timestamp(a * 1000) as last_seen, cast(1 as bigint) as n from e
    union all select refnr, 'gone', make_timestamp((b + 259200000) * 1000), make_timestamp(a * 1000), make_timestamp(b * 1000), n from e where b + 259200000 <= (select max(t) from l)""",
)
def k1_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertisements that are gone after three days without a sighting; all events come in one batch, then the timers run out."""
    folder = scratch(spark)
    with lifecycle.rocksdb_state(spark):
        seen = event_stream(spark, sf_dir).select(F.concat(F.lit("R"), (c("event_id") * c("event_id") % 997).cast("string")).alias("refnr"), "ts")
        rows = lifecycle.stream_lifecycle(seen, 3, "0 seconds")
        rows.writeStream.format("parquet").option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(lifecycle.EVENTS.format(key="refnr")).parquet(f"{folder}/table")


@R.add("k2_stream_dedupe", "select distinct 'R' || (event_id % 700) as refnr from events")
def k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    rows = streams.once(event_stream(spark, sf_dir), window="3650 days").select("refnr")
    rows.writeStream.format("parquet").option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("refnr string").parquet(f"{folder}/table")
