import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from prospectspark.llm import packing
from prospectspark.llm.packing import best_fit, default_tokenizer, encoder, evolve, pack

from .data import SCHEMA, frame, random_documents


def held(rows, got, capacity):
    """Every piece is what the tokenizer gives; sequences have no gaps and aren't too long."""
    library = Tokenizer.from_file(default_tokenizer())
    want = []
    for d, t, *_ in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        want += [(d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(x[3] for x in want) // capacity)


def test_pieces_and_sequences(spark):
    rows = random_documents(2, 300, 50) + [(900, "a <|endoftext|> b", None, None, 1), (901, "日本語 ÄÖÜ 's 'll 12 345  x\n\n y\t", None, None, 1), (None, "x y", None, None, 1), (None, "x y", None, None, 1)]
    got = pack(frame(spark, rows), default_tokenizer(), capacity=256).collect()
    bins, least = held(rows, got, 256)
    assert bins <= 1.03 * least + 2
    assert sorted(map(tuple, pack(frame(spark, rows), default_tokenizer(), capacity=256).select("doc_id", "piece", "length").collect()), key=str) == sorted(((r.doc_id, r.piece, r.length) for r in got), key=str)


def test_several_groups_and_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rows = random_documents(5, 400, 60)
    bins, least = held(rows, pack(frame(spark, rows), default_tokenizer(), capacity=300).collect(), 300)
    assert bins <= 1.06 * least + 3


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), default_tokenizer()).collect() == []


def test_evolution_never_loses_items_and_beats_first_fit():
    rng = random.Random(1)
    for _ in range(5):
        size = [rng.choice([rng.randint(1, 2047), rng.randint(300, 900)]) for _ in range(400)]
        best = evolve(size, 2048, [], random.Random(3))
        assert sorted(i for b in best for i in b) == list(range(400)) and max(sum(size[i] for i in b) for b in best) <= 2048
        assert len(best) <= len(best_fit([], sorted(range(400), key=lambda i: -size[i]), size, 2048))


def test_fast_encoder_equals_library():
    library = Tokenizer.from_file(default_tokenizer())
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab é\n\t  'sA1.,#ß日🙂\x00  ") for _ in range(rng.randint(0, 200))) for _ in range(400)] + [" " * 500, "a" * 3000, "<|endoftext|>", "\n" * 50 + "x"]
    assert encoder(default_tokenizer())(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
