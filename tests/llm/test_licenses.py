import re

import duckdb
import pytest

from prospectspark.llm.licenses import OP3_SQL, TEMPLATES, license_labels, scan_licenses

from .data import SCHEMA, frame, random_documents

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words(text)
    hits = [(i, label) for phrase, label in BASE.items() for i in range(len(w) - len(phrase) + 1) if tuple(w[i : i + len(phrase)]) == phrase]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def licensed(seed):
    rows = random_documents(seed, 40)
    phrases = [p for _, p, _ in TEMPLATES]
    for i, p in enumerate(phrases):
        w = p.split()
        near = w[: len(w) // 2] + ["inserted"] + w[len(w) // 2 :]
        rows += [(1000 + i, f"Some words; {p.upper()}!\n{p}", None, "s", 1), (2000 + i, "x " * 5 + "-".join(near), None, None, 1), (3000 + i, " ".join(w[: len(w) // 3 + 1]), None, None, 1)]
    rows += [(4000, "The MIT\nLicense mit  license.MIT-LICENSE mit x license", None, None, 1), (4001, "general public general public license", None, None, 1), (4002, "\u00e9mit license \u00c9", None, None, 1)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_base_equals_brute_force_and_all_equals_sql(spark, seed):
    rows = licensed(seed)
    got = license_labels(frame(spark, rows)).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {d: base(t) for d, t, *_ in rows} and len(got) == len(rows)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    documents = frame(spark, rows).toPandas()  # noqa: F841
    assert sorted(map(tuple, got), key=str) == sorted(duckdb.connect().execute(OP3_SQL).fetchall(), key=str)


def test_labels_of_longer_passages(spark):
    rows = licensed(3)
    got = {r.doc_id: r for r in license_labels(frame(spark, rows)).collect()}
    for i, (label, phrase, _) in enumerate(TEMPLATES):
        assert label in got[1000 + i].labels.split(",") and got[1000 + i].score == 1
        if len(phrase.split()) > 9:  # one word more leaves over 0.8 of the pairs
            assert label in got[2000 + i].labels.split(",")


def test_edge_cases(spark):
    long = "a b c " * 300_000 + "apache license " + "d e " * 400_000
    rows = [(None, "mit license", None, None, 1), (1, None, None, None, 1), (2, "", None, None, 1), (3, "mit", None, None, 1), (4, long, None, None, 1), (5, "mit license", None, None, 1), (6, "mit license", None, None, 1), (6, "apache license", None, None, 1)]
    got = sorted((tuple(r)[:6] for r in license_labels(frame(spark, rows)).collect()), key=str)
    want = [(d, *base(t)) for d, t, *_ in rows]
    assert got == sorted(want, key=str)
    assert license_labels(spark.createDataFrame([], SCHEMA)).collect() == []
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows_come_back_each(spark):
    rows = [(7, "mit license here", None, None, 1)] * 3
    got = license_labels(frame(spark, rows)).collect()
    assert len(got) == 3 and {r.labels for r in got} == {"mit"}
