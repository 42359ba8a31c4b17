"""Constraints as a report: one row for each rule with its violations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


@dataclass(frozen=True)
class Rule:
    """not_null (columns), enum (column, values), unique (columns, where), one_of (two columns, one set), reference (column, other table, its key)."""

    name: str
    kind: str
    columns: Sequence[str]
    values: Sequence[str] = ()
    where: Column | None = None
    other: DataFrame | None = None
    other_key: str = ""


def check_constraints(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, violations.  Rules on single rows share one pass; null keys are distinct."""
    single = {"not_null": lambda r: reduce(lambda a, b: a | b, [c(x).isNull() for x in r.columns]), "enum": lambda r: c(r.columns[0]).isNotNull() & ~c(r.columns[0]).isin(*r.values), "one_of": lambda r: reduce(lambda a, b: a & b, [c(x).isNull() for x in r.columns])}
    parts = []
    rowwise = [r for r in rules if r.kind in single]
    if rowwise:
        counted = df.agg(*[F.count_if(single[r.kind](r)).alias(r.name) for r in rowwise])
        parts.append(counted.unpivot([], [r.name for r in rowwise], "rule", "violations"))
    for r in rules:
        if r.kind == "unique":
            rows = df if r.where is None else df.filter(r.where)
            keyed = rows.filter(reduce(lambda a, b: a & b, [c(x).isNotNull() for x in r.columns]))
            found = keyed.groupBy(*r.columns).agg(F.count("*").alias("n")).agg(F.count_if(c("n") > 1).alias("violations"))
        elif r.kind == "reference":
            keys = r.other.select(c(r.other_key).alias(r.columns[0])).distinct()
            found = df.filter(c(r.columns[0]).isNotNull()).join(keys, list(r.columns), "left_anti").agg(F.count("*").alias("violations"))
        else:
            continue
        parts.append(found.select(F.lit(r.name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)
