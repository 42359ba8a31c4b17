import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from prospectspark.llm.prefix_trie import hashed_ends, op12_prefix_trie, prefix_trie, task_forest, turn_lists, with_shared_heads

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_lists(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(lists):
    nodes = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for key, members in nodes.items():
        below = {k: m for k, m in nodes.items() if k[: len(key)] == key}
        kids = [k for k in below if len(k) == len(key) + 1]
        leaves = sum(not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in below) for k in below)
        saved = sum((len(m) - 1) * len(k[-1][1]) for k, m in below.items() if k)
        ends = ",".join(map(str, sorted(c for c in members if len(lists[c]) == len(key))))
        out.add((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed, n, longest=7, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 12 * n), n):
        kind = rng.random()
        for turn in range(0 if kind < 0.05 else rng.randint(1, longest)):
            text = "same" if kind < 0.3 else rng.choice(["", None, "ä" * 5, "b", "hello"][: words + 1])
            rows.append((c, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", None, "assistant"]) if kind > 0.5 else "user", text))
    rows += [(c, t, "user", f"t{t}") for c in range(5000, 5040) for t in range(3)]
    rows += [(None, 1, "user", "x"), (7000, None, None, None), (7000, None, None, None)]
    rng.shuffle(rows)
    return rows


def result(lists, tasks):
    nodes, ends = prefix_trie(lists, tasks)
    digests = {(r.conv_id, r.depth): r.ends_sha256 for r in hashed_ends(ends, 3).collect()}
    none = hashlib.sha256(b"").hexdigest()
    rows = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, digests.get((r.conv_id, r.depth), none)) for r in nodes.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(("seed", "n", "tasks"), [(1, 60, 1), (2, 60, 5), (3, 150, 13), (4, 20, 40)])
def test_equals_brute_force(spark, seed, n, tasks):
    rows = conversations(seed, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "'x' as task", "1 as depth", "'y' as turns")
    lists = with_shared_heads(turn_lists(df), 100, 6)
    assert result(lists, tasks) == brute(brute_lists(rows))


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_few_different_turns_and_copies(spark, tasks):
    rng = random.Random(tasks)
    lists = {c: [("user", rng.choice(["a", "bb"])) for _ in range(rng.randint(0, 4))] for c in range(80)}
    lists |= {c: [("user", "a"), ("user", "a"), ("user", "bb")] for c in range(100, 160)}
    rows = [(c, [(hashlib.sha256(repr(t).encode()).digest(), len(t[1])) for t in turns]) for c, turns in lists.items()]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<digest:binary,size:int>>")
    assert result(df, tasks) == brute(lists)


def test_forest_of_one_task_is_contracted_to_two_paths():
    turns = [[b"a"], [b"a", b"b"], [b"a", b"c", b"d"], [b"a", b"c", b"e"], [b"b"]]
    nodes, ends, paths = task_forest([4, 3, 2, 1, 0], turns, [[1] * len(t) for t in turns])
    assert sorted(n[:2] for n in nodes) == [[1, 2], [1, 3], [2, 3], [3, 2]]
    assert paths[0].n == [5, 4] and paths[0].children == [0, 2] and paths[1].n == [0, 1]
    assert sorted(e[2:] for e in ends) == [(1, [0]), (1, [4]), (2, [3]), (3, [1]), (3, [2])]


def test_a_long_conversation_and_long_texts(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (100, 101, 205) for t in range(3000)] + [(205, 3000, "user", "x" * 5_000_000), (0, 0, "user", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    lists = with_shared_heads(turn_lists(df), 100, 6)
    nodes, _ = prefix_trie(lists, 4)
    top = {(r.conv_id, r.depth): r for r in nodes.filter("depth in (0, 3000, 3001)").collect()}
    want = brute_lists(rows)
    assert top[0, 0].n_convs == 4 and nodes.agg(F.max("depth")).first()[0] == 3001
    assert top[0, 0].n_children == len({tuple(t[:1]) for t in want.values()})


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op12_prefix_trie(spark, str(tmp_path)).collect() == []
