import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from prospectspark.llm.variants import Index, Strings, count_words, near_words, pairs_within, spelling_variants, variant_groups

from .data import SCHEMA, frame, random_documents


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    out = {}
    for w in n:
        own = [x for x in n if near(w, x)]
        top = min(own, key=lambda x: (-n[x], x), default=None)
        ok = top is not None and n[top] >= 10 * n[w]
        out[w] = [top if ok else None, n[w], len(own), n[top] if ok else None]
    for w in n:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].insert(1, root)
    return out


def counted(rows, min_length, min_count, slip):
    n = Counter()
    for d, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "[" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}


def vocabulary(seed, size, letters, longest=12):
    rng = random.Random(seed)
    out = {}
    for _ in range(size):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))
        out[w] = rng.choice([2, 3, 30, 400, 5000])
        if rng.random() < 0.6:
            i = rng.randrange(len(w) + 1)
            w = w[:i] + rng.choice(letters) + w[i + rng.randint(0, 1) :]
            out.setdefault(w, rng.choice([2, 3, 30, 400, 5000]))
    return out


def rows_of(df):
    return {r.word: [r.form, r.root, r.n, r.n_near, r.form_n] for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcdé", "aÀÿ"])
def test_index_finds_every_near_word(letters):
    words = sorted(vocabulary(3, 300, letters))
    s = Strings(words)
    q, w = pairs_within(Index(s.codes, s.start, s.length), s.codes, s.start, s.length, s.length // 2)
    got = sorted(zip(q.tolist(), w.tolist(), strict=True))
    want = sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b) and a[: len(a) // 2] == b[: len(a) // 2])
    assert got == want


@pytest.mark.parametrize(("letters", "block"), [("ab", 50_000), ("abcdé", 50_000), ("ab", 7), ("abc", 20)])
def test_groups_equal_brute_force(spark, letters, block):
    n = vocabulary(8, 400, letters)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert rows_of(variant_groups(df, block=block, buckets=3)) == brute(n)


def test_documents_equal_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abÉé") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=200)) + rng.choice([".", " Ab", "\n", ""]), None, None, 1) for i in range(40)]
    rows += [*random_documents(2, 20), (None, " ".join(words), None, None, 1), (3, "ABCDEFGh abcdefgh", None, None, 1), (3, "ABCDEFGh", None, None, 1)]
    n = counted(rows, 5, 2, 3)
    # the slip comes before the length is asked for, so runs that it shortens below 5 are gone in both
    assert rows_of(spelling_variants(frame(spark, rows), min_length=5, slip=3)) == brute(n)
    assert {r.word: r.n for r in count_words(frame(spark, rows), 7, 2, 31).collect()} == counted(rows, 7, 2, 31)


def test_very_long_words_and_texts(spark):
    long_word = "ab" * 1500
    n = {long_word: 100, long_word + "c": 3, long_word[:5] + "x" + long_word[6:]: 4, "x": 5}
    assert rows_of(variant_groups(spark.createDataFrame(list(n.items()), "word string, n long"))) == brute(n)
    rows = [(1, "alphabet omegas! " * 400_000, None, None, 1), (2, "alphabe alphabe", None, None, 1)]
    assert rows_of(spelling_variants(spark.createDataFrame(rows, SCHEMA)))["alphabe"] == ["alphabet", "alphabet", 2, 1, 400_000]


def test_ties_chains_and_empty_tables(spark):
    n = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaaac": 10, "aaaaabb": 100, "aaaabbb": 1000, "zzzzzzzz": 1}
    got = rows_of(variant_groups(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute(n)
    assert got["aaaaaaa"][:2] == ["aaaaaab", "aaaabbb"]
    assert near_words(spark.createDataFrame([], "word string, n long")).collect() == []
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert np.array_equal(Strings([]).start, [])
