"""Order of given files, counts of what is skipped, reports on empty and null input."""

from pyspark.sql import Row

from prospectspark.operators import evidence, importing, scoring, web
from prospectspark.sources import io


def test_rows_follow_the_given_order_of_files(spark, tmp_path):
    small, large = tmp_path / "a small.csv", tmp_path / "b.csv"
    small.write_text("url;name\n" + "".join(f"u{i};small\n" for i in range(3)), "latin-1")
    large.write_text("url;name\n" + "".join(f"u{i};large\n" for i in range(5000)), "latin-1")
    for given, winner in (([small, large], "small"), ([large, small], "large")):
        rows = io.read_search_exports(spark, [str(p) for p in given])
        assert [r.name for r in rows.orderBy("ord").collect()][0] == winner
        firsts = importing.merge_exports(rows, "url", "ord", [], "n")
        assert {r.name for r in firsts.filter("url in ('u0', 'u1', 'u2')").collect()} == {winner}
        assert firsts.count() == 5000


def test_skipped_rows(spark):
    rows = spark.createDataFrame([("u", "a"), ("u", "b"), ("", "c"), (None, "d"), ("v", None), ("w", "e")], "url string, name string")
    assert importing.skipped_rows(rows, "url", "name").collect() == [Row(n_read=6, skipped=3, replaced=1)]
    assert importing.skipped_rows(rows.limit(0), "url", "name").collect() == [Row(n_read=0, skipped=0, replaced=0)]


def test_crawl_counts(spark):
    sites = spark.createDataFrame([(1, True, 3, 7, None), (2, True, 1, None, None), (3, False, 0, None, "dns"), (4, False, 0, None, "")], "company_id long, reachable boolean, n_pages long, score int, error string")
    errors = spark.createDataFrame([(1, "tls"), (1, "tls"), (3, "dns")], "company_id long, error string")
    found = {(r.kind, r.value): r.n for r in web.crawl_counts(sites, errors).collect()}
    assert found == {("pages", "3"): 1, ("pages", "1"): 1, ("score", "7"): 1, ("error", "dns"): 1, ("error", "unbekannt"): 1, ("page_error", "tls"): 2}


def test_extraction_summary_counts_successes_only(spark):
    schema = "ok boolean, retries int, escalated boolean, tokens_in long, tokens_out long, seconds double, filled int, quotes int, quotes_ok int, n_signals int, dropped int"
    rows = spark.createDataFrame([(True, 1, True, 10, 2, 1.0, 4, 2, 1, 2, 0), (True, 0, False, 20, 4, 3.0, 6, 0, 0, 0, 1), (False, 9, True, 99, 99, 99.0, 9, 9, 9, 9, 9), (None,) * 11], schema)
    r = evidence.extraction_summary(rows).first()
    assert (r.n, r.succeeded, r.failed, r.repaired, r.escalated, r.tokens_in, r.tokens_out) == (4, 2, 2, 1, 1, 30, 6)
    assert (r.seconds_mean, r.filled_mean, r.quotes_mean, r.fidelity, r.without_quotes, r.n_signals, r.dropped) == (2.0, 5.0, 1.0, 0.5, 1, 2, 1)
    assert evidence.extraction_summary(rows.limit(0)).first().n == 0


def test_best_per_class_takes_the_smaller_id_on_a_tie(spark):
    rows = spark.createDataFrame([(2, 9, "A"), (1, 9, "A"), (3, 8, "A"), (4, -1, "KO")], "company_id long, score_total int, score_klasse string")
    assert {(r.score_klasse, r.company_id) for r in scoring.best_per_class(rows).collect()} == {("A", 1), ("KO", 4)}
