"""Numbers in German notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def parse_german_number(c: Column) -> Column:
    """'1.234,5 €' → 1234.5; without a comma every dot is a thousands mark; what isn't a number is null."""
    raw = F.trim(c)
    bare = F.regexp_replace(raw, "[ €% ]", "")
    negative = F.startswith(bare, F.lit("-"))
    digits = F.replace(F.replace(F.regexp_replace(bare, r"^[+-]+", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    number = F.when(F.rlike(digits, F.lit(r"^(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")), F.expr("1") * digits.try_cast("double"))
    return F.when(~F.lower(raw).isin(*config.NULL_TOKENS), F.when(negative, -number).otherwise(number))


def parse_german_int(c: Column) -> Column:
    return F.bround(parse_german_number(c)).try_cast("int")


def parse_bool(c: Column) -> Column:
    return F.lower(F.trim(c)).isin(*config.TRUE_TOKENS)


def to_thousand_eur(c: Column) -> Column:
    return F.bround(c.try_cast("double") / 1000).try_cast("long")
