"""Small documents with the cases that every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "spans string, bucket string, n string, _id string"


def random_documents(seed: int, n: int = 60, vocabulary: int = 30) -> list[tuple]:
    """Texts over few words, so that windows, lines and shingles repeat within and across documents."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(4)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 25))))
        text = rng.choice(["\n", " ", "\t\n"]).join(parts)
        if out and rng.random() < 0.2:
            text = rng.choice(out)[1] or ""
            if rng.random() < 0.5 and text:
                cut = rng.randrange(len(text))
                text = text[:cut] + rng.choice(words) + text[cut + 1 :]
        out.append((i, text, rng.choice(["en", None]), rng.choice(["a", "b", "b", "b", None]), len(text)))
    out.append((n, None, None, None, None))
    out.append((n + 1, "", "en", "a", 0))
    out.append((n + 2, " \t\n\r\x0b\x0c ", "en", "a", 7))
    out.append((n + 3, " ".join(rng.choice(words) for _ in range(4000)), "en", "c", 1))
    out.append((n + 4, "w " * 500, "en", "c", 1))
    rng.shuffle(out)
    return out


def frame(spark, rows, parts: int = 3):
    """The rows as a table with columns whose names clash with those used inside."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return df.selectExpr("*", "'x' as spans", "'y' as bucket", "1 as n", "2 as _id")
