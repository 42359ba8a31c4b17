import re
from collections import Counter

import pytest

from prospectspark.llm.quality import keep_good, quality_report

from .data import SCHEMA, frame, random_documents


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    capitals = sum(len(re.findall("[A-Z]", x)) >= 2 and not re.search("[a-z]", x) for x in w)
    chars, dup, n = sum(map(len, w)), len(lines) - len(set(lines)), len(w)
    base = n < 10 or 100 * len(again) > 20 * n
    kept = not (base or 10 * symbols > n or 2 * capitals > n or 10 * dup > 4 * len(lines) or chars > 15 * n or chars < 2 * n)
    return n, chars, symbols, dup, len(again), base, kept


@pytest.fixture(scope="module")
def rows():
    rows = random_documents(6, 120, 200)
    texts = ["A B C\nA B C\n\n \nA B C", "\n\nx\n", "x y\nx y", "##$ % &|<> " * 30, "ABC DEF GHI " * 3, "€uro 日本 " * 20, "a" * 300 + " b", "x\n", "x\ny\nx", " x\nx ", "HELLO WORLD!! " + " ".join(f"W{i}X" for i in range(30))]
    return rows + [(1000 + i, t, None, None, 1) for i, t in enumerate(texts)] + [(None, "no id", None, None, 1)] * 2


def test_equals_brute_force(spark, rows):
    got = sorted((tuple(r) for r in quality_report(frame(spark, rows)).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t, *_ in rows), key=str)


def test_filter_keeps_columns_and_good_rows(spark, rows):
    df = frame(spark, rows)
    got = keep_good(df, sample_rows=3)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, t, *_ in rows if brute(t)[-1])


def test_empty_table(spark):
    assert quality_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert keep_good(spark.createDataFrame([], SCHEMA)).collect() == []


def test_contents_decide_for_words_made_to_collide(spark):
    """Two words of 2,048 letters that agree in every polynomial hash modulo 2 ** 64 are two words, two lines and two windows."""
    from prospectspark.llm.minhash import near_duplicates
    from prospectspark.llm.substring_dedup import substring_dedup
    from prospectspark.llm.suffix_dedup import suffix_dedup

    from .data import SCHEMA

    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = "".join("ba"[bin(i).count("1") % 2] for i in range(2048))
    rest = " ".join(f"w{i}" for i in range(12))
    one = [(1, f"{a}\n{b}\n{rest}", None, None, 1)]
    assert quality_report(spark.createDataFrame(one, SCHEMA)).first().n_dup_lines == 0
    two = spark.createDataFrame([(1, f"{a} {rest}", None, None, 1), (2, f"{b} {rest}", None, None, 1)], SCHEMA)
    assert {r.doc_id: r.n_removed for r in substring_dedup(two).collect()} == {1: 0, 2: 0}
    pair = spark.createDataFrame([(1, f"{a} x y", None, None, 1), (2, f"{b} x y", None, None, 1)], SCHEMA)
    assert {r.component_id for r in near_duplicates(pair, shingle=4).collect()} == {1, 2}
    # of the two words, what stands at the same place differs everywhere, but parts of one recur in the other
    text = {1: a, 2: b}
    seen, want = set(), {}
    for d in (1, 2):
        gone = [False] * 2048
        for i in range(2048 - 99):
            if text[d][i : i + 100] in seen:
                gone[i : i + 100] = [True] * 100
            seen.add(text[d][i : i + 100])
        want[d] = sum(gone)
    got = suffix_dedup(spark.createDataFrame([(1, a, None, None, 1), (2, b, None, None, 1)], SCHEMA))
    assert {r.doc_id: r.n_removed for r in got.collect()} == want
