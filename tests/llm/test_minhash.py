import random
import re

import numpy as np
import pytest

from prospectspark.llm.components import components
from prospectspark.llm.minhash import SLOTS, drop_near_duplicates, near_duplicates, signatures, slot_of

from .data import SCHEMA, frame, random_documents


def sets_of(rows, k):
    out = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        out[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    return out


def brute(rows, k, percent=80):
    sets = sets_of(rows, k)
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def near_copies(seed, n=150):
    """Chains of edited copies, some just below and some just above the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            w = rng.choice(rows[-40:])[1].split()
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 200, 900]))]
        rows.append((i * 3, " ".join(w).upper() if rng.random() < 0.1 else " ".join(w), None, "a", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    for rows in (near_copies(seed), random_documents(seed, 50)):
        assert sorted(tuple(r) for r in near_duplicates(frame(spark, rows), shingle=4).collect()) == brute(rows, 4)


def test_filter_and_edge_cases(spark):
    rows = [(None, "a b c d e f", None, None, 1)] * 2 + [(5, "a b c d e f", None, None, 1)] * 2 + [(3, "a b c d e f", None, None, 1), (9, None, None, None, 1), (8, "", None, None, 1), (7, "q", None, None, 1), (6, "Q", None, None, 1)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect())
    assert got == [("3", 2, 3, True), ("5", 2, 3, False), ("5", 2, 3, False), ("6", 1, 6, True), ("7", 1, 6, False), ("8", 0, 8, True), ("9", 0, 9, True), ("None", 2, None, True), ("None", 2, None, True)]
    left = drop_near_duplicates(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns and sorted(str(r.doc_id) for r in left.collect()) == ["3", "6", "8", "9", "None", "None"]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_permutations_and_estimates():
    elements = np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)
    places = np.stack([slot_of(elements, j) for j in range(SLOTS)])
    assert all(sorted(c) == list(range(SLOTS)) for c in places.T.tolist())
    rng, errors = np.random.default_rng(2), []
    for n in (3, 60, 1000):
        for _ in range(40):
            pool = np.unique(rng.integers(0, 2**63, 3 * n).astype(np.uint64))
            a, b = pool[: 2 * n], pool[n // 2 : 2 * n + n // 2]
            x, y = signatures([np.sort(a), np.sort(b)])
            errors.append((x == y).mean() - len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist())))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    up = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in up.items() if k != v}


def test_small_blocks_equal_brute_force(spark, monkeypatch):
    """Buckets are cut into many pairs of blocks, of members of the largest component and of others."""
    from prospectspark.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = near_copies(7, 120)
    assert sorted(tuple(r) for r in minhash.near_duplicates(frame(spark, rows), shingle=4).collect()) == brute(rows, 4)


def test_two_sets_with_one_digest_stay_two_classes(spark):
    from prospectspark.llm.minhash import set_classes

    named = spark.createDataFrame([(1, 5, 9, 1), (2, 5, 9, 1), (3, 5, 8, 2)], "doc_id long, digest long, check long, n long")
    got = {(r.check, r.rep): r.node for r in set_classes(named).collect()}
    assert set(got) == {(9, 1), (8, 3)} and len(set(got.values())) == 2


def test_rows_that_share_a_doc_id_are_judged_by_their_own_text(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a, None, None, 1), (5, a, None, None, 1), (5, b, None, None, 1), (5, b, None, None, 1), (7, b + " z", None, None, 1), (None, a, None, None, 1)]
    got = sorted((str(r.doc_id), r.text) for r in drop_near_duplicates(frame(spark, rows)).collect())
    assert got == sorted([("3", a), ("5", b), ("5", b), ("None", a)])
