from collections import defaultdict

import duckdb
import pytest

from prospectspark.llm.mixing import OP1_SQL, copies, mix_sources

from .data import SCHEMA, frame, random_documents


def water_level(sizes, weights, most):
    """Targets by sharing the excess again and again."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, w = total - sum(fixed.values()), sum(weights[i] for i in free)
        share = {i: left * weights[i] / w for i in free}
        over = [i for i in free if share[i] > most * sizes[i] + 1e-9]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_copies(spark, seed):
    rows = random_documents(seed, 400, 40)
    got = copies(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, copies(frame(spark, rows, 7)).collect()), key=str)
    size, n, taken, target, rate = defaultdict(int), defaultdict(int), defaultdict(int), {}, {}
    for r in got:
        assert r.size == len((next(x[1] for x in rows if x[0] == r.doc_id) or "").replace("\t", " ").split()) and 0 <= r.copies <= 3
        size[r.source] += r.size
        n[r.source] += r.copies
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        rate[r.source] = r.target / max(r.source_size, 1)
    order = sorted(size, key=lambda s: (s is None, s))
    want = water_level([size[s] for s in order], [1 + i % 3 for i in range(len(order))], 3)
    for s, w in zip(order, want):
        assert target[s] == pytest.approx(w)
        docs = sum(r.source == s for r in got)
        assert abs(n[s] - rate[s] * docs) <= 1
    assert sum(target.values()) == pytest.approx(sum(size.values()))


def test_equals_sql_and_taken_words_are_near(spark):
    rows = random_documents(5, 1500, 200)
    con = duckdb.connect()
    documents = frame(spark, rows).toPandas()  # noqa: F841
    want = con.execute(OP1_SQL).fetchall()
    got = copies(frame(spark, rows)).selectExpr("doc_id", "size", "source_size", "target", "copies * size").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    b = [r for r in got if r.source_size == max(x.source_size for x in got)]
    assert abs(sum(r[4] for r in b) / b[0].target - 1) < 0.05


def test_mix_emits_rows(spark):
    rows = random_documents(3, 100)
    want = {r.doc_id: r.copies for r in copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    mixed = mix_sources(spark.createDataFrame(rows, SCHEMA))
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert got == {k: v for k, v in want.items() if v}


def test_edge_cases(spark):
    assert copies(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, None, None, 1), (2, "", None, "z", 1), (None, "a b", None, "z", 1), (3, "a b", None, "z", 1), (3, "a b", None, "z", 1)]
    got = copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 5 and sum(r.copies * r.size for r in got) == 6


def test_ids_of_any_size_and_seeds(spark):
    top = (1 << 63) - 1
    rows = [(top - i if i % 2 else i - top - 1, "a b c " * (1 + i % 7), None, "xyz"[i % 3], 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    mixes = [sorted(map(tuple, copies(df, seed=s).select("doc_id", "copies").collect())) for s in (7, 107, 207)]
    assert all(len(m) == 300 for m in mixes) and mixes[0] != mixes[1] != mixes[2]
    assert mix_sources(df).count() == sum(n for _, n in mixes[0])


def test_rows_without_id_are_dealt_over_blocks(spark):
    rows = [(None, f"w{i} b", None, "z", 1) for i in range(400)] + [(i, "a b", None, "y", 1) for i in range(10)]
    taken = copies(spark.createDataFrame(rows, SCHEMA)).groupBy("source").sum("copies").collect()
    # 820 words: z stops at neither its cap nor below, y has three times its 20
    assert {r[0]: r[1] for r in taken} == {"y": 30 if 820 / 3 > 60 else 10, "z": 380}


def test_long_text_is_one_row(spark):
    rows = [(1, "w " * 2_000_000, None, "z", 1), (2, "a", None, "z", 1)]
    got = {r.doc_id: (r.size, r.copies) for r in copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1][0] == 2_000_000 and got[1][1] == 1
