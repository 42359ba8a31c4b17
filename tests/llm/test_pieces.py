import hashlib
import random

import pytest
import sentencepiece

from prospectspark.llm.pieces import decoded, default_model, encode, vocabulary

from .data import SCHEMA, frame, random_documents

CASES = [
    "", " ", "   ", "a", " a  b ", "\n", "\n\n x\r\n", "▁x ▁▁", "ﬁ A²　b c\x00d\t", "é", "<s> </s> <unk> <0x41>",
    "﻿x", "\U0001f600\U0001f469‍\U0001f469 ok", "a" * 500, " " * 100, " " * 37 + "x" + " " * 18, "中文字符串" * 50, "1234567890 3.14159",
    "==========--------", "\x7f\x01", "ไทย", "don't can't  won't", "\U0010ffff", "שלום", "HTTPResponseCodeError", "aaaaab" * 30,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def ids_of(text: str) -> list[int]:
    import numpy as np

    return np.frombuffer(vocabulary(default_model()).encode(text), np.int32).tolist()


@pytest.mark.parametrize("text", CASES)
def test_cases(library, text):
    assert ids_of(text) == library.encode(text)


def test_random_strings(library):
    rng = random.Random(5)
    alphabets = ["ab ", "etaoin shrdlu", "the and ing ", "éèàüß abc", " \n\tx", "中文abc ", "0123456789., ", "".join(chr(c) for c in range(32, 127)), "▁ a"]
    for n in range(6000):
        text = "".join(rng.choice(alphabets[n % len(alphabets)]) for _ in range(rng.randint(1, 60)))
        assert ids_of(text) == library.encode(text), text
    for n in range(300):  # words of the vocabulary in a row, without blanks
        text = "".join(library.id_to_piece(rng.randrange(259, 32000)).replace("▁", rng.choice(["", " "])) for _ in range(30))
        assert ids_of(text) == library.encode(text), text


def test_decode_any_ids(spark, library):
    rng = random.Random(6)
    rows = [[rng.randrange(0, 32000 if n % 3 else 300) for _ in range(rng.randint(0, 12))] for n in range(600)]
    rows += [[28705, 28705, 264], [1, 28705, 264, 2], [2], [], [259], [0, 0], [196, 131], [3, 230], [1, 228, 187, 230, 264]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, ids array<int>").repartition(3)
    got = {r.i: r.t for r in df.select("i", decoded("ids", default_model()).alias("t")).collect()}
    assert [got[i] for i in range(len(rows))] == [library.decode(r) for r in rows]


def test_whole_table(spark, library):
    long_word = "ab" * 3_000_000  # longer than a step
    rows = [*random_documents(3), (None, "no id", None, None, 1), (5, "again another text", None, None, 1), (900, "Zeile eins\nzwei " * 300_000, None, None, 1), (901, long_word, None, None, 1)]
    df = encode(frame(spark, rows), default_model())
    got = sorted((str(r.doc_id), r.n, r.ids) for r in df.selectExpr("doc_id", "size(ids) as n", "sha2(array_join(cast(ids as array<string>), ' '), 256) as ids").collect())
    want = sorted((str(d), len(ids := library.encode(t or "", add_eos=True)), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()) for d, t, *_ in rows)
    assert got == want
    texts = sorted(hashlib.sha256(r.t.encode()).hexdigest() for r in df.select(decoded("ids", default_model()).alias("t")).collect())
    assert texts == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in rows)


def test_null_ids_and_empty_table(spark):
    assert spark.createDataFrame([(None,)], "ids array<int>").select(decoded("ids", default_model()).alias("t")).collect()[0].t is None
    assert encode(spark.createDataFrame([], SCHEMA), default_model()).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = 1
    path = tmp_path / "x.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        vocabulary(str(path))
