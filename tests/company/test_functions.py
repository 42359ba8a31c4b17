import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prospectspark.functions import helpers, numbers, text

c = F.col


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", make(c("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def test_normalisation(spark):
    given_ = [None, "  Müller  & Söhne ", "Straße 5", "Øre", "a-b_c"]
    assert column(spark, given_, text.norm_ws) == ["", "müller & söhne", "straße 5", "øre", "a-b_c"]
    assert column(spark, given_, text.norm_text) == ["", "muller sohne", "strasse 5", "re", "a b c"]
    assert column(spark, given_, text.norm_posting) == ["", "muller & sohne", "strae 5", "re", "a-b_c"]


def test_company_names(spark):
    names = ["Roller GmbH & Co. KG", "AG Bau e.K.", "Mbh GmbH", "Haus u. Co. KG", None, "KG", "Covestro AG"]
    assert column(spark, names, text.norm_company) == ["roller", "bau", "", "haus", "", "", "covestro"]
    assert column(spark, ["Covestro GmbH", "Bau Co. KG", "A.B."], text.norm_company_legacy) == ["covestro", "bau", "a b"]
    assert column(spark, ["X Covestro"], text.norm_company_legacy) == ["x vestro"]


def test_numbers(spark):
    raw = ["1.234,5 €", "1.5", "-2.000", "+3,25 %", "-", "k.A.", "", None, "abc", "5d", "1_000", "--4", "1e3", ",5", " 7 ", "nan"]
    assert column(spark, raw, numbers.parse_german_number) == [1234.5, 15.0, -2000.0, 3.25, None, None, None, None, None, None, None, -4.0, 1000.0, 0.5, 7.0, None]
    assert column(spark, ["2,5", "3,5", "-2,5", "x"], numbers.parse_german_int) == [2, 4, -2, None]
    assert column(spark, ["Ja ", "WAHR", "nein", "", None], numbers.parse_bool) == [True, True, False, False, None]
    assert column(spark, ["2500", "3500", None, "x"], numbers.to_thousand_eur) == [2, 4, None, None]


def test_codes_hosts_years(spark):
    assert column(spark, [" 68.32 x", "6 x", None, "43"], text.wz_code) == ["68.32", "", "", "43"]
    assert column(spark, ["WWW.A.de:80/x", "https://a.de/", "a.de/p?q", "", None, "//b.de"], text.normalize_host) == ["www.a.de:80", "a.de", "a.de", "", "", "b.de"]
    assert column(spark, ["1961-02-03", "0000-01-01", "x", None, " 1970"], text.year_of) == [1961, None, None, None, 1970]
    assert column(spark, ["Tue, 03 Feb 2015", "1999", None], text.year_in_text) == [2015, None, None]
    assert column(spark, ["2024-02-03", "2024-02-03T10:00:00Z", "bad date text", None], text.format_de_date) == ["03.02.2024", "03.02.2024", "bad date t", None]
    assert column(spark, ["Ä b--C!"], text.slug) == ["b-c"]


def test_titles_and_terms(spark):
    got = spark.createDataFrame([("Dipl.-Ing. Dr. Eva", "Prof. Berg"), (None, None)], "a string, b string").select(text.split_title(c("a"), c("b")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [("Eva", "Berg", "Prof. Dr. Dipl.-Ing. Dipl. Ing."), ("", "", "")]
    assert column(spark, ["Leiter CFO", None], lambda v: text.first_term(v, ("cfo", "Leiter"))) == ["cfo", None]
    long = "43.2 Bauinstallation und sonstige Arbeiten - aller Art"
    assert column(spark, [long, "43.2", None], lambda v: text.short_industry(v, F.lit("bau_x"))) == ["Bauinstallation und sonstige Arbeiten…", "bau x", "bau x"]


def test_token_sets(spark):
    rows = spark.createDataFrame([("a b", "a b c"), ("a", "a"), ("a b", "b c"), ("", "a")], "a string, b string")
    assert [r.o for r in rows.select(text.is_proper_token_subset(c("a"), c("b")).alias("o")).collect()] == [True, False, False, False]
    assert [r.o for r in rows.select(text.strip_place_tokens(c("a"), c("b")).alias("o")).collect()] == ["a b", "a", "a", ""]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=40), st.text("abc ", max_size=40))
def test_common_subsequence_equals_table(a, b):
    assert helpers.common_subsequence(a, b) == slow_lcs(a, b)
    s = helpers.token_similarity(a, b)
    assert s == helpers.token_similarity(b, a) and 0 <= s <= 100
    assert (s == 100) >= (sorted(set(a.split())) == sorted(set(b.split())) and bool(a.split()))


def test_similarity_anchors():
    assert round(helpers.token_similarity("roller gelsenkirchen", "matena gelsenkirchen"), 1) == 78.8
    assert helpers.token_similarity("e on", "e on one") == 100 and helpers.token_similarity("", "a") == 0
    assert helpers.token_similarity("roller", "matena") < 75


@pytest.mark.parametrize("seed", [1, 2])
def test_length_prefilter_loses_nothing(seed):
    """No pair without a shared token and with too different lengths reaches the least score."""
    rng = random.Random(seed)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in "xy")
        if a != b and abs(len(a) - len(b)) * 100 > 25 * (len(a) + len(b)):
            assert helpers.token_similarity(a, b) < 75
