import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from .data import random_documents  # noqa: E402
from .test_line_dedup import brute as line_brute  # noqa: E402
from .test_minhash import brute as near_brute  # noqa: E402
from .test_minhash import near_copies  # noqa: E402
from .test_packing import held  # noqa: E402
from .test_quality import brute as quality_brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0d]+"


def stages_by_hand(rows):
    """What the filtering stages keep."""
    rows = [r for r in rows if quality_brute(r[1])[-1]]
    stays = line_brute(rows)
    out = []
    for d, t, *rest in rows:
        lines = [x for i, x in enumerate(t.split("\n")) if not re.search(WORD, x) or i in stays.get(d, ())]
        if re.search(WORD, "\n".join(lines)):
            out.append((d, "\n".join(lines), *rest))
    kept = {d for d, _, _, k in near_brute(out, 5) if k}
    return [r for r in out if r[0] in kept]


def test_run_equals_stages_by_hand(spark, tmp_path):
    rows = [r for r in random_documents(11, 60, 400) if r[0] is not None] + [(2000 + d, t, *r) for d, t, *r in near_copies(5, 80)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = stages_by_hand(rows)
    mixed = {}
    for r in got:
        if r.piece == 0:
            mixed[r.doc_id] = mixed.get(r.doc_id, 0) + 1
    assert set(mixed) <= {r[0] for r in want} and max(mixed.values()) <= 3
    bins, least = held([r for r in want for _ in range(mixed.get(r[0], 0))], got, 2048)
    assert bins <= least + 2
    # a source with a target of at least one copy each loses no document
    share = {s: sum(len(re.findall(WORD, r[1])) for r in want if r[3] == s) for s in {r[3] for r in want}}
    order = sorted(share, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    for s in order:
        if weight[s] * sum(share.values()) / sum(weight.values()) >= share[s]:
            assert {r[0] for r in want if r[3] == s} <= set(mixed)


def test_documents_columns_between_stages(spark, tmp_path):
    rows = random_documents(12, 30, 300)
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_unique_texts_under_one_doc_id_stay(spark, tmp_path):
    words = [[f"{x}word{i % 60}{x}" for i in range(90)] for x in "abcd"]
    texts = [" ".join(w[:45]) + "\n" + " ".join(w[45:]) for w in words]
    rows = [(3, texts[0], "en", "a", 1), (5, texts[0], "en", "a", 1), (5, texts[1], "en", "a", 1), (5, texts[2], "en", "a", 1), (None, texts[3], "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert sorted((str(r.doc_id), r.text) for r in docs.collect()) == sorted([("3", texts[0]), ("5", texts[1]), ("5", texts[2]), ("None", texts[3])])
