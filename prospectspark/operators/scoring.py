"""Need scores, classes, clusters and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import text

c = F.col

#: The dossier as it is stored; numbers and truth values as text, since models write them as strings too.
STORED = (
    "struct<geschaeftsmodell: string, produkte_leistungen: array<string>, kundentyp: string, gruendungsjahr: string, familienunternehmen: struct<hinweis: string, generation: string, beleg: string>,"
    " fuehrungsstruktur: struct<gf_auf_website: array<string>, zweite_ebene_sichtbar: string, kaufmaennische_funktion_besetzt: string>,"
    " karriere: struct<offene_stellen: array<string>, kaufm_stellen: array<string>, stand: string>, nachfolge_signale: array<string>, nachfolge_intern_geregelt: string, naechste_generation: string,"
    " digitalisierung: string, besonderheiten: string, tonalitaet_website: string, ansprache_hooks: array<string>, negativ_filter: struct<insolvenz_hinweis: string, reiner_onlineshop: string, tochter_eines_konzerns: string>,"
    " belege: array<struct<signal_type: string, aussage: string, zitat: string, quelle_url: string>>, konfidenz: string>"
)


def truth(value: Column) -> Column:
    """true or false in any usual spelling, else null."""
    word = F.lower(F.trim(value))
    return F.when(word.isin("true", "t", "yes", "y", "on", "1"), True).when(word.isin("false", "f", "no", "n", "off", "0"), False)


def whole_number(value: Column) -> Column:
    return F.regexp_extract(value, r"^\s*([+-]?\d{1,9})(\.0*)?\s*$", 1).try_cast("int")


def parse_dossier(json: Column) -> Column:
    """The dossier as a struct of 17 fields: numbers and truth values may be strings; a missing list is empty, a missing text of the business model
    '', a missing hint false, a missing struct holds such defaults; what may be unknown is null.  Text that isn't JSON gives the defaults, null gives null."""
    parsed = F.from_json(json, STORED, {"mode": "PERMISSIVE"})

    def filled(d: Column) -> Column:
        texts = lambda col: F.coalesce(col, F.array().cast("array<string>"))
        hint = lambda col: F.coalesce(truth(col), F.lit(False))
        family, lead, jobs, against = d["familienunternehmen"], d["fuehrungsstruktur"], d["karriere"], d["negativ_filter"]
        fields = {
            "geschaeftsmodell": F.coalesce(d["geschaeftsmodell"], F.lit("")),
            "produkte_leistungen": texts(d["produkte_leistungen"]),
            "kundentyp": d["kundentyp"],
            "gruendungsjahr": whole_number(d["gruendungsjahr"]),
            "familienunternehmen": F.struct(hint(family["hinweis"]).alias("hinweis"), family["generation"].alias("generation"), family["beleg"].alias("beleg")),
            "fuehrungsstruktur": F.struct(
                texts(lead["gf_auf_website"]).alias("gf_auf_website"), truth(lead["zweite_ebene_sichtbar"]).alias("zweite_ebene_sichtbar"), truth(lead["kaufmaennische_funktion_besetzt"]).alias("kaufmaennische_funktion_besetzt")
            ),
            "karriere": F.struct(texts(jobs["offene_stellen"]).alias("offene_stellen"), texts(jobs["kaufm_stellen"]).alias("kaufm_stellen"), jobs["stand"].alias("stand")),
            "nachfolge_signale": texts(d["nachfolge_signale"]),
            "nachfolge_intern_geregelt": hint(d["nachfolge_intern_geregelt"]),
            "naechste_generation": d["naechste_generation"],
            "digitalisierung": d["digitalisierung"],
            "besonderheiten": d["besonderheiten"],
            "tonalitaet_website": d["tonalitaet_website"],
            "ansprache_hooks": texts(d["ansprache_hooks"]),
            "negativ_filter": F.struct(*[hint(against[n]).alias(n) for n in ("insolvenz_hinweis", "reiner_onlineshop", "tochter_eines_konzerns")]),
            "belege": F.coalesce(d["belege"], F.array().cast("array<struct<signal_type: string, aussage: string, zitat: string, quelle_url: string>>")),
            "konfidenz": d["konfidenz"],
        }
        return F.when(d.isNotNull(), F.struct(*[v.alias(k) for k, v in fields.items()]))

    return F.get(F.transform(F.array(parsed), filled), 0)  # the text is parsed once, not once for each field


def director_age(year: int) -> Column:
    return F.coalesce(F.lit(year) - F.nullif(c("gf_geburtsjahr"), F.lit(0)), c("gf_alter"))


def yes(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def plain(number: Column) -> Column:
    """A number without trailing zeros or exponent."""
    return F.regexp_replace(number.cast("decimal(20,4)").cast("string"), r"\.?0+$", "")


def criterion_values(year: int) -> dict[str, Column]:
    """What a criterion was judged by, as text, where there is more to say than its hit."""
    balance, age, settled, jobs = c("bilanzsumme_eur"), director_age(year), yes(c("d.nachfolge_intern_geregelt")), c("d.karriere.kaufm_stellen")
    source = F.when(F.nullif(c("gf_geburtsjahr"), F.lit(0)).isNotNull(), " (geburtsjahr)").otherwise(" (import)")
    note = F.when((age >= 58) & settled, " — neutralisiert: Nachfolge intern geregelt").otherwise("")
    return {
        "bilanzsumme_band": F.when(balance.isNull(), "—").otherwise(F.concat(plain(balance), F.lit(" EUR, EK "), F.coalesce(plain(c("ek_quote_pct")), F.lit("—")), F.lit(" %"))),
        "mitarbeiter_band": c("mitarbeiterzahl").cast("string"),
        "gewinn_cagr_positiv": plain(c("gewinn_cagr_pct")),
        "fokus_wz": text.wz2(c("branche_wz")),
        "gf_alter_min": F.when(age.isNull(), "unbekannt").otherwise(F.concat(age.cast("string"), source, note)),
        "familienhinweis": c("d.familienunternehmen.generation"),
        "nur_ein_gf": c("anzahl_gf").cast("string"),
        "nachfolge_intern_geregelt": F.coalesce(F.nullif(c("d.naechste_generation"), F.lit("")), F.when(settled, "ja")),
        "offene_kaufm_stelle": F.nullif(F.substring(F.array_join(jobs, "; "), 1, 80), F.lit("")),
    }


def criteria(year: int) -> dict[str, dict[str, tuple[Column, int]]]:
    """group: criterion: (hit, points).  Needs a company's columns, ``d`` (its dossier) and ``handover``."""
    balance, equity, staff, age = c("bilanzsumme_eur"), c("ek_quote_pct"), c("mitarbeiterzahl"), director_age(year)
    settled = yes(c("d.nachfolge_intern_geregelt"))
    jobs = F.coalesce(c("d.karriere.offene_stellen"), F.array().cast("array<string>"))
    wanted = F.exists(jobs, lambda j: text.any_term(j, config.ACCOUNTING_TERMS))
    return {
        "anker": {
            "bilanzsumme_band": (balance.between(1_500_000, 10_000_000) & (equity >= 0), 2),
            "mitarbeiter_band": (staff.between(10, 50), 2),
            "gewinn_cagr_positiv": (c("gewinn_cagr_pct") > 0, 1),
            "fokus_wz": (text.wz2(c("branche_wz")).isin(*config.FOCUS_WZ), 1),
        },
        "nachfolge": {
            "gf_alter_min": ((age >= 58) & ~settled, 3),
            "gf_name_in_firmenname": (c("gf_name_in_firmenname"), 1),
            "familienhinweis": (c("d.familienunternehmen.hinweis"), 1),
            "nur_ein_gf": (c("anzahl_gf") == 1, 1),
            "nachfolge_intern_geregelt": (settled, -3),
        },
        "web_bedarf": {
            "keine_kaufm_funktion": (c("d.fuehrungsstruktur.kaufmaennische_funktion_besetzt") == F.lit(False), 1),
            "offene_kaufm_stelle": ((F.size(F.coalesce(c("d.karriere.kaufm_stellen"), F.array().cast("array<string>"))) > 0) | wanted, 2),
            "zweite_ebene_unsichtbar": (c("d.fuehrungsstruktur.zweite_ebene_sichtbar") == F.lit(False), 1),
        },
        "abzuege": {
            "holding_flag": (c("holding_reason").isNotNull(), 0),
            "konzerntochter": (c("d.negativ_filter.tochter_eines_konzerns"), 0),
            "insolvenz": (c("d.negativ_filter.insolvenz_hinweis"), 0),
            "generationswechsel_vollzogen": (c("handover"), 0),
            "reiner_onlineshop": (c("d.negativ_filter.reiner_onlineshop"), -3),
        },
    }


KNOCK_OUT = ("holding_flag", "konzerntochter", "insolvenz", "generationswechsel_vollzogen")


def score_class(total: Column, knocked_out: Column) -> Column:
    return F.when(knocked_out, "KO").when(total >= 9, "A").when(total >= 5, "B").otherwise("C")


def score_companies(companies: DataFrame, dossiers: DataFrame, handover: DataFrame, year: int) -> DataFrame:
    """company_id, breakdown (group, criterion: hit, points and the value judged), total, class and cluster of each company with a dossier.

    companies: with holding_reason and gf_alter; dossiers: company_id, dossier_json; handover: key, handover.
    """
    rows = dossiers.select(c("company_id").alias("id"), parse_dossier(c("dossier_json")).alias("d")).join(companies, "id")
    rows = rows.withColumn("key", text.company_key(c("name"), c("plz"))).join(handover, "key", "left").drop("key")
    groups = criteria(year)
    values, unsaid = criterion_values(year), F.lit(None).cast("string")
    entry = lambda name, hit, points: F.struct(yes(hit).alias("hit"), F.when(yes(hit), points).otherwise(0).alias("punkte"), values.get(name, unsaid).alias("wert")).alias(name)
    breakdown = F.struct(*[F.struct(*[entry(name, *rule) for name, rule in rules.items()]).alias(group) for group, rules in groups.items()])
    rows = rows.withColumn("breakdown", breakdown)
    total = sum((c(f"breakdown.{group}.{name}.punkte") for group, rules in groups.items() for name in rules), F.lit(0))
    out = F.lit(False)
    for name in KNOCK_OUT:
        out |= c(f"breakdown.abzuege.{name}.hit")
    return rows.select(
        c("id").alias("company_id"), "name", "breakdown", total.alias("score_total"), score_class(total, out).alias("score_klasse"), F.lit(config.SCORING_VERSION).alias("scoring_version"),
        cluster_of(text.wz2(c("branche_wz"))).alias("cluster_branche"), size_band(c("bilanzsumme_eur"), c("mitarbeiterzahl")).alias("groessenband"),
        cluster_key(text.wz2(c("branche_wz")), c("bilanzsumme_eur"), c("mitarbeiterzahl")).alias("cluster_key"), director_age(year).alias("gf_alter"),
    )


def size_band(balance: Column, staff: Column) -> Column:
    """The larger band of both; null if neither is known."""
    names = list(config.SIZE_BANDS)

    def rank(value: Column, which: int) -> Column:
        out = F.when(value.isNull(), None)
        for i, limits in enumerate(config.SIZE_BANDS.values()):
            out = out.when(value <= limits[which], i)
        return out.otherwise(len(names) - 1)

    return F.get(F.array(*map(F.lit, names)), F.greatest(rank(balance, 0), rank(staff, 1)))


def cluster_of(code: Column) -> Column:
    out = F.when(code.isNull(), "rest")
    for name, codes in config.CLUSTERS.items():
        out = out.when(code.isin(*codes), name)
    return out.otherwise("rest")


def cluster_key(code: Column, balance: Column, staff: Column) -> Column:
    return F.concat(cluster_of(code), F.lit("__"), F.coalesce(size_band(balance, staff), F.lit("unbekannt")))


def criterion_hits(scores: DataFrame) -> DataFrame:
    """criterion, hits, n over all scored companies, in one aggregate."""
    names = [(g, n) for g, rules in criteria(2000).items() for n in rules]
    counted = scores.agg(F.count("*").alias("n"), *[F.count_if(c(f"breakdown.{g}.{n}.hit")).alias(n) for g, n in names])
    return counted.unpivot(["n"], [n for _, n in names], "criterion", "hits").select("criterion", "hits", "n")


def score_report(scores: DataFrame) -> DataFrame:
    """kind, value, n over class, total, cluster and whether the director's age is known, in one pass."""
    known = F.when(c("gf_alter").isNotNull(), "bekannt").otherwise("unbekannt")
    cols = {"klasse": c("score_klasse"), "score": c("score_total").cast("string"), "cluster": c("cluster_key"), "alter": known}
    rows = scores.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in cols.items()])).alias("x")).select("x.*")
    return rows.groupBy("kind", "value").agg(F.count("*").alias("n"))


def best_per_class(scores: DataFrame) -> DataFrame:
    """The best company of each class, the smaller id on a tie: the detailed examples of the report."""
    cols = [x for x in scores.columns if x != "score_klasse"]
    best = scores.groupBy("score_klasse").agg(F.min_by(F.struct(*cols), F.struct((-c("score_total")).alias("s"), "company_id")).alias("b"))
    return best.select("score_klasse", "b.*")


def top_per_cluster(scores: DataFrame, k: int) -> DataFrame:
    """The k best of each cluster key (industry and size band)."""
    from .keyed import Window

    place = F.row_number().over(Window.partitionBy("cluster_key").orderBy(F.desc("score_total"), "company_id"))
    return scores.withColumn("place", place).filter(c("place") <= k)


def unscored(dossiers: DataFrame, scores: DataFrame, companies: DataFrame, force: bool = False) -> DataFrame:
    """company_id and error of the dossiers to score; a dossier without company is an error."""
    left = dossiers if force else dossiers.join(scores.select("company_id"), "company_id", "left_anti")
    known = companies.select(c("id").alias("company_id"), F.lit(True).alias("known"))
    return left.select("company_id").join(known, "company_id", "left").select("company_id", F.when(c("known").isNull(), "company missing").alias("error"))


def age_backlog(companies: DataFrame, scores: DataFrame, min_age: int) -> DataFrame:
    """Ids of companies with a website and an old enough director, no score, and nothing that speaks against a crawl.

    companies: website, holding_reason, dup_of, excluded, gf_alter, tech_signals (JSON, null before the crawl).
    """
    flag = lambda name: F.get_json_object("tech_signals", f"$.{name}") == "true"
    crawl = c("tech_signals").isNull() | (yes(flag("reachable")) & ~yes(flag("no_text_content")))
    open_ = open_companies(companies).filter((c("gf_alter") >= min_age) & crawl)
    return open_.select("id").join(scores.select(c("company_id").alias("id")), "id", "left_anti")


def open_companies(companies: DataFrame) -> DataFrame:
    return companies.filter(c("website").isNotNull() & c("holding_reason").isNull() & c("dup_of").isNull() & ~yes(c("excluded")))


def crawl_candidates(companies: DataFrame, score: int | None = None, min_score: float | None = None, force: bool = False, limit: int | None = None) -> DataFrame:
    """Companies to crawl, by priority and balance (unknown as -1)."""
    rows = open_companies(companies)
    if not force:
        rows = rows.filter("tech_signals is null")
    if score is not None:
        rows = rows.filter(F.bround("prioritaets_score") == score)
    if min_score is not None:
        rows = rows.filter(c("prioritaets_score") >= min_score)
    rows = rows.orderBy(F.desc(F.coalesce("prioritaets_score", F.lit(-1.0))), F.desc(F.coalesce("bilanzsumme_eur", F.lit(-1.0))), "id")
    return rows.limit(limit) if limit else rows


def three_way(flag: Column) -> Column:
    return F.when(flag, "ja").when(~flag, "nein").otherwise("unbekannt")


def briefing_text(scores: DataFrame, companies: DataFrame, dossiers: DataFrame, evidence: DataFrame) -> DataFrame:
    """company_id and its briefing: class and knock-out reasons, place, key figures, succession, web need, one quote of each type, hooks.

    scores: from score_companies; dossiers: company_id, dossier_json; evidence: company_id, signal_type, zitat, url, one row for each type.
    """
    text_of, dash = text.text_or_empty, lambda col: F.coalesce(col.cast("string"), F.lit("—"))
    joined = lambda col, sep: F.array_join(F.coalesce(col, F.array().cast("array<string>")), sep)
    quote = F.concat(F.lit("  ["), c("signal_type"), F.lit('] "'), F.trim(text_of(c("zitat"))), F.lit('" — '), text_of(c("url")))
    quotes = evidence.groupBy("company_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("signal_type", quote.alias("q")))), lambda x: x["q"]), "\n").alias("quotes"))
    firms = companies.drop("gf_alter").withColumnRenamed("id", "company_id")
    rows = scores.select("company_id", "breakdown", "score_total", "score_klasse", "cluster_branche", "cluster_key", "gf_alter").join(firms, "company_id")
    rows = rows.join(dossiers.select("company_id", parse_dossier(c("dossier_json")).alias("d")), "company_id").join(quotes, "company_id", "left")
    reasons = F.array_join(F.filter(F.array(*[F.when(c(f"breakdown.abzuege.{n}.hit"), n) for n in KNOCK_OUT]), lambda x: x.isNotNull()), ", ")
    pain = F.create_map(*[F.lit(x) for pair in config.PAIN_POINTS.items() for x in pair])
    settled, hooks, signs = yes(c("d.nachfolge_intern_geregelt")), joined(c("d.ansprache_hooks"), " | "), joined(c("d.nachfolge_signale"), "; ")
    lines = [
        F.concat(text_of(c("name")), F.lit(" — Score "), c("score_total").cast("string"), F.lit(" (Klasse "), c("score_klasse"), F.lit(")"), F.when(reasons != "", F.concat(F.lit("  [K.o.: "), reasons, F.lit("]"))).otherwise("")),
        F.concat(F.lit("Standort "), dash(F.nullif(c("ort"), F.lit(""))), F.lit(" · WZ "), text.wz2(c("branche_wz")), F.lit(" · Cluster "), c("cluster_key")),
        F.concat(F.lit("Schmerzpunkt (Brief): "), F.try_element_at(pain, c("cluster_branche"))),
        F.lit(""),
        F.concat(F.lit("Kennzahlen: Bilanzsumme "), dash(F.concat(F.translate(F.format_number("bilanzsumme_eur", 0), ",", "."), F.lit(" EUR"))), F.lit(", EK-Quote "), dash(c("ek_quote_pct")), F.lit(" %, MA "), dash(c("mitarbeiterzahl")), F.lit(", Gewinn-CAGR "), dash(c("gewinn_cagr_pct")), F.lit(" %")),
        F.concat(
            F.lit("Nachfolge: GF-Alter "), F.coalesce(c("gf_alter").cast("string"), F.lit("unbekannt")), F.lit(", GF-Name im Firmennamen: "), F.when(yes(c("gf_name_in_firmenname")), "ja").otherwise("nein"),
            F.lit(", Familienunternehmen: "), F.when(yes(c("d.familienunternehmen.hinweis")), "ja").otherwise("nein"), F.lit(", Anzahl GF: "), F.coalesce(c("anzahl_gf").cast("string"), F.lit("unbekannt")),
        ),
        F.when(signs != "", F.concat(F.lit("  Signale: "), signs)),
        F.when(settled, F.concat(F.lit("  ACHTUNG Nachfolge intern geregelt: "), F.coalesce(F.nullif(c("d.naechste_generation"), F.lit("")), F.lit("nächste Generation steht bereit")))),
        F.concat(F.lit("Web-Bedarf: kaufm. Funktion besetzt: "), three_way(c("d.fuehrungsstruktur.kaufmaennische_funktion_besetzt")), F.lit(", 2. Ebene sichtbar: "), three_way(c("d.fuehrungsstruktur.zweite_ebene_sichtbar")), F.lit(", offene kaufm. Stellen: "), dash(F.nullif(joined(c("d.karriere.kaufm_stellen"), "; "), F.lit("")))),
        F.when(c("quotes").isNotNull(), F.concat(F.lit("\nBelege:\n"), c("quotes"))),
        F.when(hooks != "", F.concat(F.lit("\nHooks: "), hooks)),
    ]
    return rows.select("company_id", F.concat_ws("\n", *lines).alias("briefing"))
