from collections import Counter

from prospectspark.llm.mixing import copies, mix_sources

from .data import SCHEMA, random_documents


def test_repeated_and_null_ids_are_taken_row_by_row(spark):
    rows = [(None if i % 3 == 0 else i // 4, t, l, s, 10_000 + i) for i, (_, t, l, s, _) in enumerate(random_documents(9, 200, 40))]
    df = spark.createDataFrame(rows, SCHEMA)
    counted = copies(df).collect()
    got = mix_sources(df).collect()
    want, found = Counter(), Counter()
    for r in counted:
        want[r.doc_id, r.source, r.size] += r.copies
    for r in got:
        found[r.doc_id, r.source, len((r.text or "").replace("\t", " ").split())] += 1
    assert found == +want
    # n_chars tells the rows apart; max_repeats holds for each
    assert max(Counter(r.n_chars for r in got).values()) <= 3
    assert set(map(tuple, got)) <= set(rows)
    again = mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_equal_rows_without_id(spark):
    df = spark.createDataFrame([(None, "a b", None, "z", 1)] * 20, SCHEMA)
    assert mix_sources(df).count() == 20
