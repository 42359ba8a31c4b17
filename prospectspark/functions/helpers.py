"""The two vectorised helpers; everything else is built-in Spark."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def ascii_fold(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition, then only ASCII stays."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word operation for each character of b."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def token_similarity(a: str | None, b: str | None) -> float:
    """Similarity of two token sets from 0 to 100: shared tokens against the rests, joined in sorted order."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    shared, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if shared and not (only_x and only_y):
        return 100.0
    s, p, q = len(shared), len(only_x), len(only_y)
    joint = bool(s)
    longer_x, longer_y = s + joint + p, s + joint + q
    distance = p + q - 2 * common_subsequence(only_x, only_y)
    best = 100.0 - 100.0 * distance / (longer_x + longer_y)
    if joint:
        best = max(best, 100.0 - 100.0 * (1 + p) / (s + longer_x), 100.0 - 100.0 * (1 + q) / (s + longer_y))
    return best


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def round_score(scores: pd.Series) -> pd.Series:
    """One decimal, rounding the binary value."""
    return scores.map(lambda s: None if pd.isna(s) else round(float(s), 1)).astype("float64")
