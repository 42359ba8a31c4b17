"""License scans by diagonal voting.  DataFrame operations only.

The words of a text (A-Z lower-cased, runs of letters and digits and of anything beyond ASCII) give rolling pairs.  The hash of each pair is
joined to the positions of the same pair in the templates, which are a fixed list of phrases and so have a proven size.
A hit at word i of the text and word j of a template votes for the diagonal i - j.  Votes are added up per text, template and
diagonal; diagonals of one template that lie at most ``gap`` apart (a word more or less between) merge to one span; a span
counts if the share of the template's pairs that it covers reaches the template's threshold.  The pairs' own words are compared at
the join, so a hash alone decides nothing.

Base labels: a phrase's place is a diagonal with all its pairs (mit license, apache license, general public license).  Further
labels come from longer passages of well-known licenses, from 0.8 of their pairs on.

Edge cases: null counts as empty; a text of fewer words than a phrase has no hits; rows without doc_id are counted and labelled
by themselves; rows that repeat doc_id and text come back once for each row, each with all places of its text; a very
long text is scanned whole; spans that tie in their share all count; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

#: Bytes that separate words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A word of the text as it is, capitals included.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Fixed phrases: label, words, whether it is a base phrase.
TEMPLATES = (
    ("mit", "mit license", True),
    ("apache", "apache license", True),
    ("gpl", "general public license", True),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", False),
    ("mit", "released under the mit license", False),
    ("apache", "licensed under the apache license version 2 0", False),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", False),
    ("gpl", "licensed under the gnu general public license", False),
    ("gpl", "it under the terms of the gnu general public license as published by the free software foundation", False),
    ("lgpl", "gnu lesser general public license", False),
    ("agpl", "gnu affero general public license", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", False),
    ("bsd", "bsd 3 clause license", False),
    ("bsd", "bsd 2 clause license", False),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", False),
    ("cc", "licensed under a creative commons attribution", False),
    ("cc", "this work is licensed under a creative commons", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", False),
    ("unlicense", "this is free and unencumbered software released into the public domain", False),
)
THRESHOLD = 0.8
GAP = 2


def words(text: Column) -> Column:
    """Lower-cased words, for texts of any length."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def template_pairs(spark: SparkSession) -> DataFrame:
    """One row for each pair of neighbouring words of each template: a fixed number of rows."""
    rows = []
    for t, (label, phrase, base) in enumerate(TEMPLATES):
        w = phrase.split(" ")
        rows += [(t, label, base, len(w), i, f"{a} {b}") for i, (a, b) in enumerate(zip(w, w[1:], strict=False))]
    pairs = spark.createDataFrame(rows, "template int, label string, base boolean, length int, at int, template_pair string")
    return pairs.withColumn("hash", F.xxhash64("template_pair"))


def scan_licenses(documents: DataFrame, threshold: float = THRESHOLD, gap: int = GAP) -> DataFrame:
    """Spans: doc_id, text_key, label, base, first and last word, share of the template's pairs."""
    w = F.col("w")
    pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    texts = documents.select("doc_id", text_key(), words(F.col("text")).alias("w")).filter(F.size("w") > 1)
    rolling = texts.select("doc_id", "text_key", F.posexplode(pairs).alias("place", "pair")).withColumn("hash", F.xxhash64("pair"))
    hits = rolling.join(F.broadcast(template_pairs(documents.sparkSession)), "hash").filter("pair = template_pair")
    votes = hits.groupBy("doc_id", "text_key", "template", "label", "base", "length", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.min("place").alias("first_word"), (F.max("place") + 1).alias("last_word"), F.collect_set("at").alias("covered")
    )
    # neighbouring diagonals of a passage with a word more or less: one span
    line = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    far = (F.col("diagonal") - F.lag("diagonal").over(line) > gap) | F.lag("diagonal").over(line).isNull() | F.col("base")
    merged = (
        votes.withColumn("span", F.sum(far.cast("int")).over(line))
        .groupBy("doc_id", "text_key", "template", "label", "base", "length", "span")
        .agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("covered"))
    )
    share = F.col("covered") / (F.col("length") - 1)
    return merged.withColumn("share", share).filter(F.when(F.col("base"), F.col("share") == 1.0).otherwise(F.col("share") >= threshold))


def text_key() -> Column:
    """Tells rows apart that repeat a doc_id with another text."""
    return F.xxhash64("text").alias("text_key")


def license_labels(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spans = scan_licenses(documents).groupBy("doc_id", "text_key").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long")
    rows = documents.select("doc_id", text_key(), n_words.alias("n_words"))
    found = spans.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    empty = F.lit("")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", empty).alias("base_labels"), F.coalesce("labels", empty).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(read_table(spark, sf_dir, "documents"))


_ROWS = ", ".join(f"({t}, '{label}', {str(base).lower()}, {len(p.split())}, {i}, '{a} {b}')" for t, (label, p, base) in enumerate(TEMPLATES) for i, (a, b) in enumerate(zip(p.split(), p.split()[1:], strict=False)))

OP3_SQL = rf"""
with t(template, label, base, len, pos, pair) as (values {_ROWS}),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
g as (select doc_id, w, unnest(range(1, len(w))) as i from d),
h as (select doc_id, template, label, base, len, pos, i - 1 as place, i - 1 - pos as diagonal from (select doc_id, i, w[i] || ' ' || w[i + 1] as pair from g) join t using (pair)),
v as (select doc_id, template, label, base, len, diagonal, min(place) as a, list(distinct pos) as covered from h group by all),
f as (select *, case when base or lag(diagonal) over o is null or diagonal - lag(diagonal) over o > {GAP} then 1 else 0 end as far from v window o as (partition by doc_id, template order by diagonal)),
s as (select *, sum(far) over (partition by doc_id, template order by diagonal) as span from f),
m as (select doc_id, template, label, base, len, span, min(a) as a, len(list_distinct(flatten(list(covered)))) / (len - 1) as share from s group by doc_id, template, label, base, len, span),
k as (select * from m where case when base then share = 1 else share >= {THRESHOLD} end),
r as (select doc_id, count(*) filter (base) as n_base, min(a) filter (base) as first_word, max(a) filter (base) as last_word,
 coalesce(array_to_string(list_sort(list(distinct label) filter (base)), ','), '') as base_labels, array_to_string(list_sort(list(distinct label)), ',') as labels, max(share) as score from k group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
 coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score from d left join r using (doc_id)
"""
