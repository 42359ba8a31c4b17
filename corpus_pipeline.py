"""Stages from raw documents to packed sequences.

Edge cases, for every stage: a null or empty text has no words and the first stage rejects it; a very long text is judged, cut into lines and
packed whole; rows that repeat a doc_id, or have none, stay rows of their own, each judged by its own text (line dedup and near dedup only remove
rows with a doc_id); ties go to the smaller doc_id and the earlier line; an empty table gives an empty result;
columns beyond those of documents are carried to the last stage, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from prospectspark.llm.common import shared_dir
from prospectspark.llm.line_dedup import keep_first_lines
from prospectspark.llm.minhash import drop_near_duplicates
from prospectspark.llm.mixing import mix_sources
from prospectspark.llm.packing import default_tokenizer, pack
from prospectspark.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are similar to an earlier one go, and documents of which no word is left."""
    return keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the smallest doc_id stays."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix_sources(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return pack(docs, default_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Near-duplicate grouping and packing have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
