"""Readers and writers: exports in CSV, JSON lines, tables, id lists."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_search_exports(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Semicolon-separated Latin-1 exports, all strings, with file name and ord for "the first wins": place of the file in the given list, path, row.

    Spark deals files over tasks by size, so a row number alone would not follow the given order.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.csv(given, sep=";", encoding="ISO-8859-1", header=True, mode="PERMISSIVE")
    path = F.col("_metadata.file_path")
    plain = F.replace(path, F.lit("%20"), F.lit(" "))
    under = lambda p: F.endswith(plain, F.lit(p)) | F.contains(plain, F.lit(p.rstrip("/") + "/"))
    place = F.coalesce(*[F.when(under(p), i) for i, p in enumerate(given)], F.lit(len(given)))
    order = F.struct(place.alias("place"), path.alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", F.col("_metadata.file_name").alias("file"), order.alias("ord"))


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 with commas, all strings; quoted cells may hold line breaks and doubled quotes."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")


def read_directors_csv(spark: SparkSession, path: str) -> DataFrame:
    """One row for each person, in file order."""
    return read_master_csv(spark, path).withColumn("ord", F.monotonically_increasing_id())


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank and broken lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    broken = "_broken string"
    parsed = lines.select(F.from_json("value", f"{schema}, {broken}", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.filter("r._broken is null").select("r.*").drop("_broken")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_table(spark: SparkSession, source: str, columns: Sequence[str] = (), **jdbc: str) -> DataFrame:
    """A whole table: a Parquet path, or with ``url`` a JDBC table; partitionColumn, lowerBound, upperBound and numPartitions split its read."""
    df = spark.read.format("jdbc").options(dbtable=source, **jdbc).load() if "url" in jdbc else spark.read.parquet(source)
    return df.select(*columns) if columns else df


def split_points(keys: DataFrame, key: str, splits: int) -> list:
    """At most splits - 1 keys that deal the rows evenly, however the keys are spread; a bounded list."""
    shares = [i / splits for i in range(1, splits)]
    found = keys.agg(F.percentile_approx(key, F.array(*map(F.lit, shares)), F.lit(100 * splits)).alias("p")).first().p if shares else None
    return sorted(set(found or []))


def read_while_growing(spark: SparkSession, source: str, key: str, splits: int = 8, **jdbc: str) -> DataFrame:
    """A table that others write to meanwhile: the largest key is fixed first, and no row beyond it is read, however late a split begins.

    A JDBC table (``url``) is read in splits between quantiles of its keys, which a first pass over the key column finds; a Parquet path is read as its
    files are, up to the key.  Rows without key can't be told from later ones and stay out; an empty table gives an empty result.
    """
    if "url" not in jdbc:
        df = spark.read.parquet(source)
        return df.filter(F.col(key) <= F.lit(df.agg(F.max(key)).first()[0]))
    options = {k: v for k, v in jdbc.items() if k != "url"}
    keys = spark.read.format("jdbc").options(query=f"select {key} from {source} where {key} is not null", **jdbc).load()
    name = keys.columns[0]
    top = keys.agg(F.max(name)).first()[0]
    if top is None:
        return spark.read.jdbc(jdbc["url"], source, predicates=["1 = 0"], properties=options)
    points = [p for p in split_points(keys.filter(F.col(name) <= F.lit(top)), name, splits) if p < top]
    text = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    edges = [None, *points, top]
    between = [" and ".join(x for x in (a is not None and f"{key} > {text(a)}", f"{key} <= {text(b)}") if x) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return spark.read.jdbc(jdbc["url"], source, predicates=between, properties=options)


def read_id_list(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Lines that are bare ids or JSON objects with the key; blank lines are skipped."""
    line = F.trim("value")
    value = F.when(F.startswith(line, F.lit("{")), F.get_json_object(line, f"$.{key}")).otherwise(line)
    return spark.read.text(path).filter(line != "").select(value.alias(key)).distinct()


def select_by_id_list(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows whose key is in the list; entries that are no value of the key's type select nothing."""
    return df.join(ids.select(F.col(key).try_cast(df.schema[key].dataType).alias(key)), key, "left_semi")


def write_export(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str], kind: str = "csv") -> None:
    """A sorted export with a fixed column list; text takes the first column only."""
    rows = df.orderBy(*order).select(*columns)
    if kind == "text":
        rows.select(F.col(columns[0]).cast("string").alias("value")).write.mode("overwrite").text(path)
    else:
        rows.write.mode("overwrite").csv(path, header=True, escape='"')


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/prospectspark"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: later steps see one and the same table."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
