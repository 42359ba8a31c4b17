import hashlib
import re

import pytest

from prospectspark.llm.substring_dedup import substring_dedup

from .data import SCHEMA, frame, random_documents


def brute(rows, window):
    words = {d: re.findall(r"[^\x20\x09-\x0d]+", t or "") for d, t, *_ in rows}
    first = {}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = random_documents(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in substring_dedup(frame(spark, rows), buckets=5).collect()}
    assert got == brute(rows, 13)


def test_small_window_and_many_parts(spark):
    rows = random_documents(9, 40, 6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in substring_dedup(frame(spark, rows, 8), window=3, buckets=3).collect()}
    assert got == brute(rows, 3)


def test_rows_without_id_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, None, None, 1), (1, text, None, None, 1), (1, text, None, None, 1), (2, text, None, None, 1)]
    got = sorted((r.doc_id or -1, r.n_removed) for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 0), (1, 0), (1, 0), (2, 20)]


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
