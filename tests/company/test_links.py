"""Links of pages against the standard library, and bad values that must not stop a job."""

from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from prospectspark.functions import numbers, urls
from prospectspark.operators import ads, evidence, web
from prospectspark.sources import io

c = F.col
BASES = ["https://www.a.de", "https://www.a.de/", "https://www.a.de/x/", "http://a.de/x/y.html?q=1", "https://a.de:8080/a/b/c/d"]
REFS = [
    "jobs.html", "/team", "../news/", "../../../up", "./", ".", "..", "?p=2", "#top", "", "x?y=/../z", "//other.com/ueber-uns", "HTTPS://B.de/a/../b#f", "mailto:a@b.de", "javascript:void(0)", "tel:+49", "a/./b/../c", "/a/b/..", "/..", "g;x=1/../y",
    "https:jobs.html", "b:c", " /blank ", "a//b", "//h", "x/#y", "/%C3%BC?a=b&c#d",
]


def test_resolution_equals_the_standard_library(spark):
    df = spark.createDataFrame([(b, r) for b in BASES for r in REFS], "b string, r string")
    got = {(x.b, x.r): x.u for x in df.select("b", "r", urls.resolved(c("b"), c("r")).alias("u")).collect()}
    for (b, r), u in got.items():
        want = urldefrag(urljoin(b, r.strip()))[0]
        assert u == want or not want.startswith("http"), (b, r, u, want)


def test_links_of_a_page(spark):
    html = """<!-- <a href="/karriere-alt">x</a> --><script>'<a href="/karriere-js">'</script>
    <a>no</a><a name=x>Karriere</a><a href="jobs.html">Offene <b>Stellen</b></a><a href="//other.com/ueber-uns">Firma</a><A
    HREF = /team title='a > b'>Wir</A><a data-href="/about" href="../news/?a=1&amp;b=2#t">Neues<a href='https://a.de/produkte'>P"""
    df = spark.createDataFrame([(1, "https://www.a.de/x/", html), (2, "https://b.de", None), (3, "https://b.de", "<a href=")], "page_id long, url string, html string")
    got = {r.page_id: [(x.link, x.label) for x in r.links] for r in web.page_links(df).collect()}
    assert got == {
        1: [("https://www.a.de/x/jobs.html", "offene stellen"), ("https://www.a.de/team", "wir"), ("https://www.a.de/news/?a=1&b=2", "neues"), ("https://a.de/produkte", "p")],
        2: [], 3: [],
    }
    kinds = {"karriere": ("Stellen",), "about": ("firma", "team"), "news": ("news", "neues"), "home": ("x",)}
    found = {r.type: r.link for r in web.classify_links(df, kinds).collect()}
    assert found == {"karriere": "https://www.a.de/x/jobs.html", "about": "https://www.a.de/team", "news": "https://www.a.de/news/?a=1&b=2"}
    pages = web.select_pages(df.select("page_id", c("url").alias("home")).join(web.classify_links(df, kinds), "page_id", "left"), ("about", "karriere", "news"), 3)
    assert [(r.page_id, r.place, r.type) for r in pages.orderBy("page_id", "place").collect()] == [(1, 0, "home"), (1, 1, "about"), (1, 2, "karriere"), (2, 0, "home"), (3, 0, "home")]


def test_a_long_attribute(spark):
    html = f'<a title="{"y" * 200_000}" class={"z" * 200_000} href="/jobs">{"w " * 100_000}</a>'
    assert [x.link for x in web.page_links(spark.createDataFrame([(1, "https://a.de", html)], "page_id int, url string, html string")).first().links] == ["https://a.de/jobs"]


def test_quotes_lose_the_marks_around_them(spark):
    quotes = spark.createDataFrame([(1, '"Familienbetrieb seit 1950."'), (1, "Seit 1950!"), (1, ""), (1, "made up words"), (1, None), (2, "x")], "company_id int, zitat string")
    texts = spark.createDataFrame([(1, "Wir sind ein Familienbetrieb seit 1950 in Ulm")], "company_id int, body string")
    assert {r.company_id: (r.ok, r.total) for r in evidence.quote_fidelity(quotes, texts).collect()} == {1: (2, 5), 2: (0, 1)}


def test_bad_values_are_null(spark, tmp_path):
    df = spark.createDataFrame([("99.999.999.999",), ("12",), (None,)], "v string")
    assert [r.n for r in df.select(numbers.parse_german_int(c("v")).alias("n")).collect()] == [None, 12, None]
    assert [r.n for r in spark.createDataFrame([(1e300,), (2500.0,)], "v double").select(numbers.to_thousand_eur(c("v")).alias("n")).collect()] == [None, 2]
    raw = spark.createDataFrame([(1, "indeed", '{"datePosted":17040672000000000}'), (2, "indeed", '{"datePosted":1704067200000}'), (3, "indeed", '{"datePosted":99999999999999999999999}')], "id int, source string, payload string")
    assert {r.id: r.posted for r in ads.unify_job_sources(raw).collect()} == {1: None, 2: "2024-01-01", 3: None}
    tiers = spark.createDataFrame([("wordpress 20240101123456",), ("typo3 99999999999999999999999999999999999999999999",), ("joomla 3",)], "g string")
    assert [r.t for r in tiers.select(web.cms_rating(c("g"), F.lit(""))["tier"].alias("t")).collect()] == ["modern", "unbekannt", "veraltet"]
    (tmp_path / "ids.txt").write_text("5\nfive\n99999999999999999999\n")
    assert [r.id for r in io.select_by_id_list(spark.range(9), io.read_id_list(spark, str(tmp_path / "ids.txt"))).collect()] == [5]


def test_quotes_equal_the_substring_rule(spark):
    import random

    rng = random.Random(9)
    words = ["a", "ab", "abc", "haus", "hausbau", "familienbetrieb", "betrieb", "1950", "in", "ulm", "seit"]
    texts = {i: " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for i in range(12)}
    quotes = []
    for i in range(400):
        k = rng.randrange(13)
        t = texts.get(k, "")
        a = rng.randrange(len(t) + 1)
        q = t[a : a + rng.choice([3, 8, 9, 12, 20, 45])] if rng.random() < 0.7 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 8)))
        quotes.append((k, rng.choice(['"', "", ". "]) + q + rng.choice(["!", "", '."'])))

    def found(q, body):
        toks = q.split()
        if len(toks) >= 6:
            return any(" ".join(toks[i : i + 6]) in body for i in range(len(toks) - 5))
        return len(q) >= 8 and q in body

    want = {}
    for k, q in quotes:
        q = " ".join(q.split()).strip(" \"'.,;:!?-")
        ok, total = want.get(k, (0, 0))
        want[k] = (ok + found(q, texts.get(k, "")), total + 1)
    df = spark.createDataFrame(quotes, "company_id int, zitat string")
    got = {r.company_id: (r.ok, r.total) for r in evidence.quote_fidelity(df, spark.createDataFrame(list(texts.items()), "company_id int, body string")).collect()}
    assert got == want


def test_payloads_are_parsed_once_and_broken_ones_kept_apart(spark):
    raw = spark.createDataFrame(
        [
            (1, "indeed", '{"company": "", "companyName": "N", "title": 7, "location": "Ulm", "isRemote": true}'),
            (2, "stepstone", '{"company": false, "companyName": 0, "employer": "E", "city": "Kiel", "title": {"a": 1}}'),
            (3, "arbeitsagentur", '{"company": "A", "contact_firstname": "V", "contact_lastname": null}'),
            (4, "indeed", "no json"), (5, "indeed", None), (6, "indeed", "[1]"), (7, "other", "{}"),
        ],
        "id int, source string, payload string",
    )
    out = ads.unify_job_sources(raw)
    got = {r.id: (r.company, r.title, r.location, r.contact, r.remote_hint) for r in out.collect()}
    assert got[1] == ("N", "7", "Ulm", None, True) and got[2][0] == "E" and got[3] == ("A", None, None, "V", False)
    assert set(got) == {1, 2, 3, 4, 5, 6} and got[4] == got[5] == got[6] == (None, None, None, None, False)
    assert sorted(r.id for r in ads.broken_payloads(raw).collect()) == [4, 5, 6]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1
