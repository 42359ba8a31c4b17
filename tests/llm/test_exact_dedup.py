import hashlib
from collections import defaultdict

import pytest

from prospectspark.llm.exact_dedup import ContentTable, exact_dedup, grace

from .data import SCHEMA, frame, random_documents


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    out = []
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        out += [(d, keep, len(ids), d == keep, hashlib.sha256(text.encode()).hexdigest()) for d in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("memory", [1 << 20, 3000])
def test_equals_brute_force(spark, memory):
    rows = random_documents(4, 150, 5)
    least, most = -(1 << 63), (1 << 63) - 1
    rows += [(least, "at the end", None, None, 1), (least, "x", None, None, 1), (most, "y", None, None, 1), (None, "y", None, None, 1), (least, "z", None, None, 1), (None, "z", None, None, 1)]
    rows += [(None, "x", None, None, 1), (7, "x", None, None, 1), (7, "x", None, None, 1), (None, "only", None, None, 1)]
    assert sorted((tuple(r) for r in exact_dedup(frame(spark, rows), memory=memory, partitions=2).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_table_compares_content_of_equal_hashes():
    t = ContentTable(1)
    for text in [b"a", b"b", b"a", b"c"] * 3:
        t.add(5, text, 1, 1)
    assert sorted((r[1], r[3]) for r in t.rows) == [(b"a", 6), (b"b", 3), (b"c", 3)]


def test_recursion_leaves_no_files(tmp_path):
    records = [((i * 7919) << 20 | i % 3, str(i % 50).encode() * 200, i, 1) for i in range(300)]
    records = [(hash(t) & (1 << 63) - 1, t, d, n) for _, t, d, n in records]
    got = sorted((r[1], r[2], r[3]) for r in grace(iter(records), 1500, 0, str(tmp_path)))
    assert [x[2] for x in got] == [6] * 50 and not list(tmp_path.iterdir())


def test_one_hash_for_all_still_ends(tmp_path):
    got = list(grace(((9, str(i).encode() * 100, i, 1) for i in range(40)), 500, 0, str(tmp_path)))
    assert len(got) == 40
