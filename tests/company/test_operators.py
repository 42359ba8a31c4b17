from pyspark.sql import functions as F

from prospectspark.operators import ads, evidence, importing, integrity, keyed, outreach, signals, web
from prospectspark.operators.scoring import parse_dossier
from prospectspark.sources import io
from prospectspark.streaming import streams

c = F.col


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_twice_equals_once(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, v string, w int")
    new = spark.createDataFrame([(2, None, True), (3, "c", False)], "id int, v string, x boolean")
    once = keyed.upsert(old, new, ["id"])
    assert rows(once) == [(1, "a", 5, None), (2, None, 6, True), (3, "c", None, False)]
    assert rows(keyed.upsert(once, new, ["id"])) == rows(once)
    kept = keyed.upsert(old.select("id", "v"), new.select("id", "v"), ["id"], "ignore")
    assert rows(kept) == [(1, "a"), (2, "b"), (3, "c")] and rows(keyed.upsert(kept, new.select("id", "v"), ["id"], "ignore")) == rows(kept)


def test_samples(spark):
    df = spark.createDataFrame([(i, "abbcccc"[i]) for i in range(7)], "id int, s string")
    assert [r.id for r in keyed.stratified_round_robin(df, "s", ["id"], 5).collect()] == [3, 1, 0, 4, 2]
    assert [r.id for r in keyed.even_spread_sample(df, ["id"], 3).orderBy("id").collect()] == [0, 3, 6]
    assert [r.id for r in keyed.even_spread_sample(df, ["id"], 1).collect()] == [0]
    assert rows(keyed.even_spread_sample(df.filter("id < 0"), ["id"], 3)) == []


def test_duplicates_take_the_larger_company(spark):
    schema = "id int, strasse string, plz string, ort string, vertreter_1 string, umsatz_eur double, bilanzsumme_eur double"
    df = spark.createDataFrame([(1, "Weg 1", "1", "A", "V", None, 5.0), (2, "weg  1", "1", "a", "v", 9.0, None), (3, "Weg 1", "1", "A", "V", 9.0, None), (4, "", "1", "A", "V", 1.0, 1.0), (5, "Weg 1", "1", "A", None, 1.0, 1.0)], schema)
    assert {r.id: r.dup_of for r in importing.mark_duplicates(df).collect()} == {1: 2, 2: None, 3: 2, 4: None, 5: None}


def test_city_traps(spark):
    df = spark.createDataFrame([("Kassel, Hessen",), ("Kassel",), ("Neu-Ulm",), ("",), (None,), ("München/Kiel",)], "w string").select(ads.detect_city(c("w")).alias("x")).select("x.*")
    assert [tuple(r) for r in df.collect()] == [(False, "Essen"), (True, "Kassel"), (True, "Ulm"), (False, None), (False, None), (False, "München")]


def test_payload_fields_that_are_empty_or_zero_are_missing(spark):
    df = spark.createDataFrame([(1, "indeed", '{"company":"","companyName":"B","datePosted":0,"postedAt":1704067200000,"isRemote":false}'), (2, "other", "{}")], "id int, source string, payload string")
    got = ads.unify_job_sources(df).collect()
    assert [(r.id, r.company, r.posted, r.remote_hint) for r in got] == [(1, "B", "2024-01-01", False)]


def test_matching_stages(spark):
    postings = spark.createDataFrame(
        [("R1", "E.ON SE", [("10001", "Ulm"), ("10001", "x")], None, None), ("R2", "Roller Ulm GmbH", [("10001", "Ulm")], None, None), ("R3", "Alpha Beta AG", [(None, None)], "10009", "Ulm"), ("R4", "Nix", [], None, None)],
        "refnr string, arbeitgeber string, places array<struct<plz:string,ort:string>>, plz string, ort string",
    )
    firms = spark.createDataFrame([(1, "E.ON One GmbH", "10001", None, 60), (2, "Matena Ulm", "10001", None, None), (3, "Alpha Beta", "10001", None, 51), (4, "E On", "10001", None, 1), (5, "E On", "10001", 4, 1), (6, "", "10001", None, 1)], "id int, name string, plz string, dup_of int, gf_alter int")
    got = {(r.refnr, r.company_id): (r.match_stufe, r.match_score) for r in signals.match_postings(postings, firms).collect()}
    assert got == {("R1", 4): ("exakt", 100.0), ("R1", 1): ("fuzzy_grenzfall", 100.0), ("R3", 3): ("region", 100.0)}
    assert signals.unmatched_without_plz(postings).first().n == 1


def test_region_takes_the_first_place_of_a_prefix(spark):
    postings = spark.createDataFrame([("R", "Neu Bau", [("10001", "Neu"), ("10002", "Bau")], None, None)], "refnr string, arbeitgeber string, places array<struct<plz:string,ort:string>>, plz string, ort string")
    assert [(r.plz, r.place) for r in signals.located(postings).orderBy("plz").collect()] == [("10001", "neu"), ("10002", "bau")]
    firsts = signals.located(postings).groupBy("prefix").agg(F.min_by("place", "pos").alias("p")).collect()
    assert [tuple(r) for r in firsts] == [("100", "neu")]


def test_links_take_the_first_free_type(spark):
    html = '<a href="/jobs">Jobs und Firma</a><a href="http://x.de/karriere">Karriere, Firma</a><a href="mailto:a@b">Firma</a><a href="http://other.de/firma">Firma</a><A HREF="/news#top">News</A>'
    df = spark.createDataFrame([(1, "http://www.x.de/", html), (2, "http://y.de", None)], "page_id int, url string, html string")
    found = {r.type: r.link for r in web.classify_links(df, {"karriere": ("jobs", "karriere"), "about": ("firma",), "news": ("news",)}).collect()}
    assert found == {"karriere": "http://www.x.de/jobs", "about": "http://x.de/karriere", "news": "http://www.x.de/news"}


def test_main_text(spark):
    html = "<head><title>t</title></head><script>var a='</p>';</script><NAV>x</NAV><p>A&amp;B&nbsp;<b>c</b><!-- no --></p><footer>f</footer>"
    assert spark.createDataFrame([(html,), (None,)], "h string").select(web.main_text(c("h")).alias("t")).collect()[0].t == "A&B c"


def test_nested_navigation_goes_whole(spark):
    html = "<p>a</p><nav class=x><ul><li><NAV><b>in</b></NAV></li><li>out</li></ul></nav><footer>f<footer>g</footer>h</footer ><nav>never closed<p>b</p>" + "<nav>" + "<i>x</i>" * 20_000 + "</nav><p>c</p>"
    assert spark.createDataFrame([(html,)], "h string").select(web.main_text(c("h")).alias("t")).first().t == "a never closed b c"


def test_context_stops_in_the_block_that_crosses(spark):
    pages = spark.createDataFrame([(1, 1, "news", "u1", "n" * 30), (1, 2, "about", "u2", "\n" + "a" * 10), (1, 3, "team", "u3", " "), (1, 4, "x", None, "z")], "company_id int, page_id int, page_type string, url string, text_content string")
    firms = spark.createDataFrame([(1, "N", "1", "O", None, "V"), (2, "M", "2", "P", "W", None)], "id int, name string, plz string, ort string, branche_wz string, vertreter_1 string")
    heads = {r.company_id: r.head for r in evidence.context_head(firms).collect()}
    assert heads[1].startswith("FIRMA: N\nORT: 1 O\n") and heads[1].count("\n") == 6
    whole = heads[1] + "\n--- Seite [about] u2 ---\n" + "a" * 10 + "\n" + "\n--- Seite [news] u1 ---\n" + "n" * 30 + "\n"
    for cut in (0, 12, 40):
        got = {r.company_id: r.context for r in evidence.assemble_context(pages.filter("page_id < 4"), firms, ("about", "news"), len(whole) - cut).collect()}
        assert got == {1: whole[: len(whole) - cut], 2: heads[2]}


def test_dossier_coercion_and_errors(spark):
    raw = spark.createDataFrame([(1, '{"geschaeftsmodell": 5, "kundentyp": {"a": 1}, "karriere": {"offene_stellen": []}}'), (2, "no json"), (3, None)], "company_id int, dossier_json string")
    got = {r.company_id: (r.d and r.d.geschaeftsmodell, r.d and r.d.kundentyp, r.error) for r in evidence.parse_dossiers(raw).collect()}
    assert got[1] == ("5", '{"a":1}', None) and got[2][2] and got[3] == (None, None, "not a JSON object")
    filled = evidence.fields_filled(evidence.parse_dossiers(raw.filter("company_id = 1"))).first().filled
    assert filled == 2


def test_dossier_defaults(spark):
    json = '{"gruendungsjahr": "1987", "familienunternehmen": {"hinweis": "true", "generation": 2}, "fuehrungsstruktur": {"zweite_ebene_sichtbar": "no"}, "nachfolge_signale": null, "nachfolge_intern_geregelt": 1}'
    raw = spark.createDataFrame([(json,), ('{"gruendungsjahr": 1950.0}',), ('{"gruendungsjahr": "um 1900"}',), ("{}",)], "j string")
    full, decimal, vague, empty = (r.d for r in raw.select(parse_dossier(raw.j).alias("d")).collect())
    assert len(empty) == 17
    assert (full.gruendungsjahr, decimal.gruendungsjahr, vague.gruendungsjahr, empty.gruendungsjahr) == (1987, 1950, None, None)
    assert full.familienunternehmen == (True, "2", None) and empty.familienunternehmen == (False, None, None)
    assert full.fuehrungsstruktur == ([], False, None) and full.nachfolge_intern_geregelt is True
    assert empty.geschaeftsmodell == "" and empty.nachfolge_signale == empty.belege == [] and empty.negativ_filter == (False, False, False) and empty.karriere == ([], [], None)


def test_curation_masks(spark):
    frame = spark.createDataFrame(
        [
            (1, "A", 9, 60, False, False, 500, 100),
            (2, "A", 8, 60, False, True, 500, 100),  # settled by its dossier
            (3, "KO", 7, 60, True, False, 500, 100),  # the generations have changed
            (4, "A", 6, 60, False, False, 5_000, 100),  # too much revenue
            (5, "A", 5, 60, False, False, None, 100),  # unknown revenue
        ],
        "company_id int, klasse string, score int, gf_alter int, handover boolean, settled boolean, revenue_k int, balance_k int",
    ).selectExpr("*", "'x' as name", "'y' as ort", "false as consultant")
    ids = lambda **how: [r.company_id for r in outreach.curation_filter(frame, **how).collect()]
    assert ids() == [1, 4, 5]
    assert ids(show_settled=True) == [1, 2, 4, 5, 3]
    assert ids(revenue_k=(0, 1_000)) == [1, 5]
    assert ids(revenue_k=(0, 1_000), unknown_size=False) == [1]


def test_region_labels(spark):
    rows = spark.createDataFrame([("50",), ("99",), ("",), (None,)], "p string")
    assert [r[0] for r in rows.select(outreach.region_label(rows.p)).collect()] == ["Köln/Rhein-Erft", "99", "?", "?"]


def test_quotes(spark):
    q = spark.createDataFrame([(1, "one two three four five six seven x"), (1, "short it"), (1, "nope"), (2, "a b c d e f")], "company_id int, zitat string")
    t = spark.createDataFrame([(1, "zero one  two three four five SIX seven eight short it")], "company_id int, body string")
    assert rows(evidence.quote_fidelity(q, t)) == [(1, 3, 2), (2, 1, 0)]


def test_reviews_and_letters_are_idempotent(spark):
    old = spark.createDataFrame([(1, 1, "lead", True, ""), (2, 2, None, True, "x")], "company_id int, wave int, decision string, selected boolean, note_self string")
    new = spark.createDataFrame([(3, "lead", None), (4, None, " "), (5, "", "note ")], "company_id int, decision string, note_self string")
    once = outreach.merge_reviews(old, new, 2)
    assert rows(once) == [(1, 1, "lead", True, ""), (3, 2, "lead", True, ""), (5, 2, None, False, "note")]
    assert rows(outreach.merge_reviews(once, new, 2)) == rows(once)
    letters = spark.createDataFrame([(1, "letter", 1, "sent")], "company_id int, channel string, wave int, status string")
    queued = outreach.queue_letters(letters, old.select("company_id"), 1)
    assert rows(queued) == [(1, "letter", 1, "sent"), (2, "letter", 1, "queued")] and rows(outreach.queue_letters(queued, old.select("company_id"), 1)) == rows(queued)


def test_constraints(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "a"), (1, 2, "z")], "x int, y int, k string")
    rule = integrity.Rule
    got = {r.rule: r.violations for r in integrity.check_constraints(df, [rule("n", "not_null", ["x"]), rule("e", "enum", ["k"], ("a", "b")), rule("o", "one_of", ["x", "y"]), rule("u", "unique", ["x", "y"]), rule("p", "unique", ["x"], where=c("k") == "a"), rule("f", "reference", ["y"], other=df.filter("y = 9"), other_key="y")]).collect()}
    assert got == {"n": 1, "e": 1, "o": 1, "u": 1, "p": 0, "f": 2}


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("n;w\nK\xf6ln;1\nUlm;\n".encode("latin-1"))
    assert [(r.n, r.w) for r in io.read_search_exports(spark, str(tmp_path / "a.csv")).collect()] == [("Köln", "1"), ("Ulm", None)]
    (tmp_path / "ids.txt").write_text('5\n\n {"id": 7, "x": 1}\n5\n')
    assert sorted(r.id for r in io.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["5", "7"]
    df = spark.createDataFrame([(5,), (6,), (7,)], "id long")
    assert [r.id for r in io.select_by_id_list(df, io.read_id_list(spark, str(tmp_path / "ids.txt"))).orderBy("id").collect()] == [5, 7]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(f"R{i % 7}", f"2024-01-{1 + i % 20:02d} 00:00:00") for i in range(60)], "refnr string, d string").select("refnr", c("d").cast("timestamp").alias("ts"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.stream_sightings(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("refnr", "first_seen", "last_seen", "n")) == rows(streams.sightings(df))
