import random
import re

import pytest

from prospectspark.llm.line_dedup import keep_first_lines, line_report

from .data import SCHEMA, frame, random_documents

WORD = r"[^\x20\x09-\x0d]+"


def brute(rows, percent=80, min_words=1):
    """For each document the numbers of the lines that stay, of those with enough words."""
    lines = []
    for d, t, *_ in rows:
        if d is not None and t is not None:
            lines += [((d, i), frozenset(re.findall(WORD, x))) for i, x in enumerate(t.split("\n")) if len(re.findall(WORD, x)) >= min_words]
    stays = {}
    for p, s in lines:
        hit = any(q < p and 100 * len(s & z) >= percent * len(s | z) for q, z in lines)
        stays.setdefault(p[0], set())
        if not hit:
            stays[p[0]].add(p[1])
    return stays


def variants(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    lines = []
    for _ in range(160):
        if lines and rng.random() < 0.6:
            w = rng.choice(lines).split()
            for _ in range(rng.randint(0, 1 + len(w) // 8)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 9, 20, 60, 200]))]
        lines.append(" ".join(w))
    rng.shuffle(lines)
    return [(i, "\n".join(lines[i * 4 : i * 4 + 4]) + "\n" * (i % 3), None, "s", 1) for i in range(40)]


@pytest.mark.parametrize(("seed", "least"), [(1, 5), (2, 1), (3, 1)])
def test_equals_brute_force(spark, seed, least):
    rows = variants(seed) + [(d + 1000 if d is not None else d, *r) for d, *r in random_documents(seed, 25)]
    stays = brute(rows, min_words=least)
    got = line_report(frame(spark, rows), min_words=least).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for d, t, *_ in rows if d == r.doc_id)
        counts = [len(re.findall(WORD, x)) for x in (text or "").split("\n")]
        kept = sorted(stays.get(r.doc_id, ()))
        assert (r.n_lines, r.n_long, r.n_removed, r.kept_long) == (sum(c > 0 for c in counts), sum(c >= least for c in counts), sum(c >= least for c in counts) - len(kept), ",".join(map(str, kept)))


def test_texts_and_edge_cases(spark):
    line = "one two three four five six"
    rows = [(None, line, None, None, 1), (1, line + "\nshort\n\n" + line, None, None, 1), (2, line, None, None, 1), (2, line, None, None, 1), (3, "short\n" + line + " seven", None, None, 1), (4, None, None, None, 1), (5, "", None, None, 1), (6, line.upper(), None, None, 1)]
    df = frame(spark, rows)
    left = keep_first_lines(df, min_words=5)
    assert left.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted([("None", line), ("1", line + "\nshort\n"), ("3", "short"), ("4", None), ("5", ""), ("6", line.upper())], key=str)
    every = {("None", line), ("1", line + "\nshort\n"), ("4", None), ("5", ""), ("6", line.upper())}
    assert {(str(r.doc_id), r.text) for r in keep_first_lines(df).collect()} == every
    assert line_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert keep_first_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_common_word_in_many_sets(spark):
    """More sets than FEW meet by one key: some similar to the earliest, some to another one only, most to none."""
    rng = random.Random(5)
    lines = []
    for i in range(150):
        base = [f"{'abc'[i % 3]}{k}" for k in range(8)]
        lines.append(" ".join(["common", *base[: 8 - i % 2], f"own{i}" if i % 5 else "own", *[f"x{rng.randrange(4)}" for _ in range(i % 3)]]))
    rows = [(i, line, None, "s", 1) for i, line in enumerate(lines)]
    rows += [(500 + i, "common " + " ".join(f"n{rng.randrange(9999)}" for _ in range(3)), None, "s", 1) for i in range(150)]
    stays = brute(rows)
    got = {r.doc_id: r.kept_long for r in line_report(frame(spark, rows)).collect()}
    assert got == {d: ",".join(map(str, sorted(stays[d]))) for d, *_ in rows}


def test_a_very_long_line_and_other_blanks(spark):
    rng = random.Random(6)
    long = [f"w{rng.randrange(10**6)}" for _ in range(400_000)]
    rows = [(1, " ".join(long), None, None, 1), (2, "\t".join(long[:-3]), None, None, 1), (3, "a\tb\x0bc\x0cd\re", None, None, 1), (4, "  e d c  b a", None, None, 1), (5, "\t\r", None, None, 1)]
    got = {r.doc_id: (r.n_lines, r.kept_long) for r in line_report(frame(spark, rows)).collect()}
    assert got == {1: (1, "0"), 2: (1, ""), 3: (1, "0"), 4: (1, ""), 5: (0, "")}


def test_rows_that_share_a_doc_id_keep_their_own_lines(spark):
    shared, own = "one shared line of six words", "another line that stands alone here"
    rows = [(1, f"{shared}\nfirst of its kind is this", None, None, 1), (5, f"{own}\n{shared}", None, None, 1), (5, f"{shared}\nnothing like the others at all", None, None, 1), (5, shared, None, None, 1)]
    got = sorted((r.doc_id, r.text) for r in keep_first_lines(frame(spark, rows)).collect())
    assert got == [(1, f"{shared}\nfirst of its kind is this"), (5, own), (5, "nothing like the others at all")]
