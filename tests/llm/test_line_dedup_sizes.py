import random

from pyspark.sql import functions as F

from prospectspark.llm.line_dedup import candidate_pairs, distinct_sets, line_report, met

from .data import frame
from .test_line_dedup import brute


def test_sets_of_far_sizes_do_not_meet_and_no_similar_pair_is_lost(spark):
    """One rare word in lines of very different sizes; lines that grow word by word through the bounds of the size classes."""
    rng = random.Random(7)
    lines = [" ".join(["rare", *[f"s{i}w{k}" for k in range(8 if i % 2 else 79)]]) for i in range(60)]
    for n in (7, 8, 9, 25, 26, 27, 28, 80, 81, 82):
        base = [f"b{n}x{k}" for k in range(n)]
        for more in range(0, n // 3):
            words = base + [f"g{n}m{k}" for k in range(more)]
            rng.shuffle(words)
            lines.append(" ".join(words))
    rng.shuffle(lines)
    rows = [(i, line, None, "s", 1) for i, line in enumerate(lines)]
    stays = brute(rows)
    docs = frame(spark, rows)
    assert {r.doc_id: r.kept_long for r in line_report(docs).collect()} == {d: ",".join(map(str, sorted(stays[d]))) for d, *_ in rows}
    size = {i: len(set(line.split())) for i, line in enumerate(lines)}
    sets = distinct_sets(docs, 80, 1).cache()
    keys = met(sets, 80).groupBy("key").agg(F.collect_set("doc_id").alias("d")).collect()
    assert all(max(size[d] for d in r.d) < 9 * min(size[d] for d in r.d) for r in keys)
    assert all(size[r.u_doc] * 5 >= size[r.v_doc] * 4 and size[r.v_doc] * 5 >= size[r.u_doc] * 4 for r in candidate_pairs(sets, 80).collect())
    sets.unpersist()
