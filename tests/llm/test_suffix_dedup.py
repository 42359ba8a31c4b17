import hashlib

import numpy as np
import pytest

from prospectspark.llm.suffix_dedup import BASES, SuffixFamily, gram_hashes, suffix_dedup

from .data import SCHEMA, frame, random_documents


def brute(rows, length):
    texts = {d: (t or "").encode() for d, t, *_ in rows}
    seen, out = set(), {}
    for d in sorted(texts):
        b, flags = texts[d], bytearray(len(texts[d]))
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            if k in seen:
                flags[i : i + length] = b"\x01" * length
            seen.add(k)
        kept = bytes(x for x, f in zip(b, flags) if not f)
        out[d] = (len(b), sum(flags), len([x for x in bytes(flags).split(b"\x00") if x]), hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("seed,length", [(1, 100), (2, 100), (3, 40), (4, 20)])
def test_equals_brute_force(spark, seed, length):
    rows = random_documents(seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in suffix_dedup(frame(spark, rows), length=length, buckets=5, batch=500).collect()}
    assert got == brute(rows, length)


def test_rows_without_id_and_repeated_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(50)) * 1 + "".join(chr(97 + i * 7 % 19) + str(i) for i in range(60))
    rows = [(None, text, None, None, 1), (1, text, None, None, 1), (1, text, None, None, 1), (2, text, None, None, 1)]
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 0), (1, 0), (1, 0), (2, len(text))]


def test_empty_table(spark):
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_family_over_batches():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    family, seen, n = SuffixFamily(data, 9, BASES[0]), set(), 0
    for a in range(0, 3900, 130):
        flags = family.add(np.arange(a, a + 130))
        for i, f in zip(range(a, a + 130), flags):
            k = data[i : i + 9].tobytes()
            assert f == (k in seen)
            seen.add(k)
            n += 1
    assert sum(len(x) for x, _ in family.levels) == len(seen) and len(family.levels) <= 6


@pytest.mark.parametrize("width", [1, 2, 3, 7, 24, 100])
def test_gram_hashes_depend_on_content_only(width):
    data = np.frombuffer(bytes(range(200)) * 2, np.uint8)
    h = gram_hashes(data, width, BASES[0])
    assert len(h) == 401 - width and (h[: 201 - width] == h[200:]).all() and len(set(h[:100].tolist())) == 100
