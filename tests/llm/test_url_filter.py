import random

from prospectspark.llm.url_filter import judge_urls, rule_table, with_verdict

SCHEMA = "page_id long, url string, html string, key string, stretch string"


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best and best[4]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    labels = ["com", "net", "example", "www", "a", "b", "É", "xn--p", ""]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    paths = ["", "/", "/en/", "/en/x", "/es/", "/fr/y?z#q", "?q=/en/", "#/en/", "/en", "/EN/\n/"]
    rules = sorted({(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(["/", "", "/en/", "/en", "/es/"])) for _ in range(40)})
    urls = [rng.choice(["http://", "HTTPS://", "", "a/b://", "x://y://"]) + rng.choice(hosts).upper() + rng.choice(paths) for _ in range(800)]
    urls += ["http://hot.example.com/en/" + str(i) for i in range(500)] + [None, "", "://", "http://", "http://user@example.com:80/en/"]
    rows = [(2**60 + i, u, None, "k", "s") for i, u in enumerate(urls)] + [(None, "http://a.com/", None, "", "")] * 2
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(5), table, stretches=7).collect()
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *brute(u, rules)) for i, u, *_ in rows), key=key)


def test_rules_and_verdicts(spark):
    urls = ["http://www.Example.com/en/1", "http://m.example.com/en/1", "http://m.example.com/fr/1", "http://x.net/fr/", "http://x.net/en/", "http://adult-x.org/", "no url", "http://com/"]
    rows = with_verdict(judge_urls(spark.createDataFrame([(i, u, "", "", "") for i, u in enumerate(urls)], SCHEMA), rule_table(spark))).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in rows] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow"), ("net/fr/", "block"), (None, "allow"), (None, "block"), (None, "block"), ("com/", "allow")]


def test_only_whole_words_block_a_host(spark):
    hosts = ["www.xxxlutz.de", "spamhaus.org", "casinotheater.ch", "xxx.de", "my-casino.ch:80", "a.porn", "spam", "user@x.de"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").selectExpr("host", "cast(null as string) as verdict")
    assert [r.verdict for r in with_verdict(df).collect()] == ["allow"] * 3 + ["block"] * 4 + ["allow"]


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA), rule_table(spark)).collect() == []
