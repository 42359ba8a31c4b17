"""Company lists: import, cleansing, directors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import numbers, text
from .keyed import first_by_key

c = F.col


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(text.text_or_empty(col)), F.lit(""))


def merge_exports(rows: DataFrame, url: str, order: str, representatives: list[str], count: str) -> DataFrame:
    """The first sighting of each url; the director count is filled from the representative columns where it is empty."""
    given = rows.withColumn(url, F.trim(text.text_or_empty(c(url)))).filter(c(url) != "")
    firsts = first_by_key(given, [url], [order])
    filled = sum((F.when(blank_to_null(c(r)).isNotNull(), 1).otherwise(0) for r in representatives), F.lit(0))
    known = text.text_or_empty(c(count)) if count in rows.columns else F.lit("")
    return firsts.withColumn(count, F.when(known != "", known).when(filled > 0, filled.cast("string")).otherwise(""))


def merge_counts(rows: DataFrame, url: str) -> DataFrame:
    """Rows in all, without url, and repeated."""
    key = F.nullif(F.trim(text.text_or_empty(c(url))), F.lit(""))
    per = rows.select(key.alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(c("k").isNull(), c("n"))), F.lit(0)).alias("no_url"), F.coalesce(F.sum(F.when(c("k").isNotNull(), c("n") - 1)), F.lit(0)).alias("dups"))


def map_company(rows: DataFrame, names: dict[str, str], whole: dict[str, str], money: dict[str, str], flags: dict[str, str], representatives: list[str]) -> DataFrame:
    """Typed columns from an all-string export; the arguments name the export's columns by target.  The row itself stays as JSON."""
    people = F.filter(F.array(*[F.trim(text.text_or_empty(c(r))) for r in representatives]), lambda p: p != "")
    return rows.select(
        *[blank_to_null(c(src)).alias(out) for out, src in names.items()],
        *[numbers.parse_german_int(c(src)).alias(out) for out, src in whole.items()],
        *[numbers.parse_german_number(c(src)).alias(out) for out, src in money.items()],
        *[numbers.parse_bool(c(src)).alias(out) for out, src in flags.items()],
        F.when(F.size(people) > 0, people).alias("ges_vertreter"),
        F.to_json(F.struct("*")).alias("raw"),
    )


def latest_by_key(rows: DataFrame, url: str, name: str, order: str) -> DataFrame:
    """Rows with url and name; the last row of each url wins."""
    return first_by_key(rows.filter((text.text_or_empty(c(url)) != "") & (text.text_or_empty(c(name)) != "")), [url], [F.desc(order)])


def skipped_rows(rows: DataFrame, url: str, name: str) -> DataFrame:
    """One row: rows read, those without url or name, and those that a later row of their url replaces."""
    usable = (text.text_or_empty(c(url)) != "") & (text.text_or_empty(c(name)) != "")
    per = rows.groupBy(usable.alias("usable"), F.when(usable, c(url)).alias("key")).agg(F.count("*").alias("n"))
    of = lambda col: F.coalesce(F.sum(col), F.lit(0))
    return per.agg(of(c("n")).alias("n_read"), of(F.when(~c("usable"), c("n"))).alias("skipped"), of(F.when(c("usable"), c("n") - 1)).alias("replaced"))


def holding_reason(wz: Column, balance: Column, revenue: Column) -> Column:
    """Why a company looks like a holding, or null."""
    code = text.wz_code(wz)
    by_code = F.lit(False)
    for prefix in config.HOLDING_PREFIXES:
        by_code |= F.startswith(code, F.lit(prefix))
    odd = (balance > 1_000_000) & (revenue.isNull() | (revenue < balance * 0.05))
    return F.when(by_code, F.concat(F.lit("wz_"), code)).when(odd, "bilanz_umsatz_implausibel")


def mark_duplicates(companies: DataFrame) -> DataFrame:
    """dup_of: the anchor of the group with the same address and first representative; null for anchors and single companies."""
    norm = {k: text.norm_ws(c(k)) for k in ("strasse", "plz", "ort", "vertreter_1")}
    keyed = companies.select("*", *[v.alias(f"__{k}") for k, v in norm.items()])
    group = Window.partitionBy(*[f"__{k}" for k in norm])
    order = [F.desc(F.coalesce("umsatz_eur", F.lit(0.0))), F.desc(F.coalesce("bilanzsumme_eur", F.lit(0.0))), F.asc("id")]
    usable = (c("__strasse") != "") & (c("__vertreter_1") != "")
    # rows that can't be grouped take no part, so they don't meet in one window either
    grouped = keyed.filter(usable).withColumn("__anchor", F.first("id").over(group.orderBy(*order)))
    marked = grouped.withColumn("dup_of", F.when(c("__anchor") != c("id"), c("__anchor")))
    rest = keyed.filter(~usable).withColumn("dup_of", F.lit(None).cast(companies.schema["id"].dataType))
    return marked.drop("__anchor").unionByName(rest).drop(*[f"__{k}" for k in norm])


def oldest_by_company(persons: DataFrame, order: str, fetched: Column) -> DataFrame:
    """key, number of directors, birth year of the oldest and when that row was fetched."""
    directors = persons.filter(F.trim(text.text_or_empty(c("ist_gf"))) == "1").select(
        text.company_key(c("firma"), c("plz")).alias("key"), text.year_of(c("gf_geburtsdatum")).alias("year"), c(order).alias("ord"), fetched.alias("fetched")
    )
    return directors.groupBy("key").agg(F.count("*").alias("directors"), F.min(F.when(c("year").isNotNull(), F.struct("year", "ord", "fetched"))).alias("oldest"))


def enrich_directors(companies: DataFrame, persons: DataFrame, year: int, order: str, fetched: Column) -> DataFrame:
    """Birth year, age and source of the oldest director, and the director count where the persons know one."""
    found = oldest_by_company(persons, order, fetched)
    joined = companies.withColumn("key", text.company_key(c("name"), c("plz"))).join(found, "key", "left").drop("key")
    born = c("oldest.year")
    return joined.select(
        *[x for x in companies.columns if x not in ("gf_geburtsjahr", "anzahl_gf")],
        F.coalesce(born, c("gf_geburtsjahr")).alias("gf_geburtsjahr"),
        F.when(born.isNotNull(), F.lit(year) - born).alias("gf_alter"),
        F.when(born.isNotNull(), F.concat(F.lit("register/"), F.substring(text.text_or_empty(c("oldest.fetched")), 1, 10))).alias("gf_quelle"),
        F.coalesce("directors", "anzahl_gf").cast("int").alias("anzahl_gf"),
    )


def company_size(companies: DataFrame, jobs: DataFrame) -> DataFrame:
    """jobs with the largest revenue (else balance) of a company with their key."""
    sizes = companies.select(text.company_key(c("name"), c("plz")).alias("key"), F.coalesce("umsatz_eur", "bilanzsumme_eur").alias("size")).filter("size is not null")
    largest = sizes.groupBy("key").agg(F.max("size").alias("size"))
    return jobs.withColumn("key", text.company_key(c("name"), c("plz"))).join(largest, "key").drop("key")


def handover_flag(persons: DataFrame, year: int) -> DataFrame:
    """key and handover: two directors or more share a surname, one of them known to be under fifty."""
    rows = persons.filter((F.trim(text.text_or_empty(c("ist_gf"))) == "1") & (F.trim(text.text_or_empty(c("gf_nachname"))) != "")).select(
        text.company_key(c("firma"), c("plz")).alias("key"), F.lower(F.trim("gf_nachname")).alias("surname"), text.year_of(c("gf_geburtsdatum")).alias("born")
    )
    families = rows.groupBy("key", "surname").agg((F.count("*") >= 2).alias("several"), F.coalesce(F.bool_or(F.lit(year) - c("born") < 50), F.lit(False)).alias("young"))
    return families.groupBy("key").agg(F.bool_or(c("several") & c("young")).alias("handover"))


def oldest_director(persons: DataFrame, order: str, age: Column) -> DataFrame:
    """Per older company key: age, names and title of the oldest director, the first on a tie."""
    rows = persons.filter("ist_gf = '1'").select(text.norm_company_legacy(c("firma")).alias("key"), age.alias("age"), c(order).alias("ord"), "gf_vorname", "gf_nachname").filter("age is not null")
    best = rows.groupBy("key").agg(F.max_by(F.struct("age", "gf_vorname", "gf_nachname"), F.struct("age", (-c("ord")).alias("o"))).alias("b"))
    return best.select("key", "b.age", text.split_title(F.trim("b.gf_vorname"), F.trim("b.gf_nachname")).alias("s")).select("key", "age", "s.first", "s.last", "s.title")


def persons_by_company(persons: DataFrame, year: int, order: str) -> DataFrame:
    """key and its people, the oldest first, unknown ages last."""
    born = text.year_of(c("gf_geburtsdatum"))
    rows = persons.select(
        text.company_key(c("firma"), c("plz")).alias("key"),
        F.struct((-F.coalesce(F.lit(year) - born, F.lit(-1))).alias("rank"), c(order).alias("ord"), F.trim(F.concat_ws(" ", "gf_vorname", "gf_nachname")).alias("name"), (F.lit(year) - born).alias("age"), (c("ist_gf") == "1").alias("is_director")).alias("p"),
    )
    people = rows.groupBy("key").agg(F.sort_array(F.collect_list("p")).alias("people"))
    return people.select("key", F.transform("people", lambda p: F.struct(p["name"].alias("name"), p["age"].alias("age"), p["is_director"].alias("is_director"))).alias("people"))


def latest_file_per_key(files: DataFrame, persons: DataFrame, order: str) -> DataFrame:
    """key and the newest file of its first job that has one.  files: name, like ``<job>+AD-<time>.pdf``."""
    parts = files.filter(F.contains("name", F.lit("+AD-"))).select(F.split_part("name", F.lit("+AD-"), F.lit(1)).alias("job_key"), "name")
    newest = parts.groupBy("job_key").agg(F.max("name").alias("name"))
    rows = persons.select(text.company_key(c("firma"), c("plz")).alias("key"), "job_key", c(order).alias("ord")).join(newest, "job_key")
    return rows.groupBy("key").agg(F.min_by("name", "ord").alias("file"))


def import_report(companies: DataFrame, year: int) -> DataFrame:
    """One row of coverage counts."""
    known = c("gf_geburtsjahr").isNotNull()
    return companies.agg(
        F.count("*").alias("n"), F.count_if(c("holding_reason").isNotNull()).alias("holding"), F.count_if(c("dup_of").isNotNull()).alias("dup"), F.count_if(text.text_or_empty(c("website")) != "").alias("with_website"), F.count("bilanzsumme_eur").alias("with_balance"),
        F.count("mitarbeiterzahl").alias("with_staff"), F.count_if(known).alias("with_birth_year"), F.count_if(known & (F.lit(year) - c("gf_geburtsjahr") >= 58)).alias("from_58"),
    )


def report_counts(companies: DataFrame, top: int = 8) -> DataFrame:
    """kind, value, n: holding reasons (six characters), priorities (-1 for none), the most frequent industries."""
    reasons = companies.filter("holding_reason is not null").groupBy(F.substring("holding_reason", 1, 6).alias("value")).agg(F.count("*").alias("n")).select(F.lit("reason").alias("kind"), "value", "n")
    priority = companies.groupBy(F.coalesce(c("prioritaets_score").try_cast("int"), F.lit(-1)).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit("priority").alias("kind"), "value", "n")
    codes = companies.select(text.wz2(c("branche_wz")).alias("value")).filter("value <> ''").groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(top)
    return reasons.unionByName(priority).unionByName(codes.select(F.lit("industry").alias("kind"), "value", "n"))
