"""Queries on sources and sinks (A): written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import io
from ..sources.fixtures import fixture
from .common import Registry
from .outreach_queries import scratch

R = Registry()
c = F.col


@R.add("a1_search_exports", "select cast(ord as varchar) as id, nullif(url, '') as url, name || ' ä' as name from v_export_rows", ("v_export_rows",))
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    rows = fixture(spark, sf_dir, "v_export_rows").select(c("ord").alias("id"), "url", F.concat("name", F.lit(" ä")).alias("name"))
    rows.write.csv(path, sep=";", encoding="ISO-8859-1", header=True, emptyValue="")
    return io.read_search_exports(spark, path).select("id", "url", "name")


@R.add("a2_master_csv", "select cast(id as varchar) as id, name, strasse || chr(10) || '\"x\"; ' || ort as address from v_companies", ("v_companies",))
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    rows = fixture(spark, sf_dir, "v_companies").select("id", "name", F.concat("strasse", F.lit('\n"x"; '), "ort").alias("address"))
    rows.write.csv(path, header=True, quoteAll=True, escape='"')
    return io.read_master_csv(spark, path)


@R.add("a3_jsonl", "select company_id, wave, decision, selected from v_reviews", ("v_reviews",))
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    rows = fixture(spark, sf_dir, "v_reviews")
    good = rows.select(F.to_json(F.struct("company_id", "wave", "decision", "selected")).alias("value"))
    good.unionByName(rows.filter("company_id % 50 = 0").select(F.when(c("company_id") % 100 == 0, " ").otherwise("{broken").alias("value"))).write.text(path)
    return io.read_jsonl(spark, path, "company_id long, wave int, decision string, selected boolean")


@R.add("a4_read_table", "select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity < 10")
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.read_table(spark, f"{sf_dir}/lineitem.parquet", ("l_orderkey", "l_partkey", "l_quantity")).filter("l_quantity < 10")


@R.add("a5_select_by_id_list", "select id, name from v_companies where id % 5 in (0, 1)", ("v_companies",))
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    firms = fixture(spark, sf_dir, "v_companies")
    line = F.when(c("id") % 5 == 0, c("id").cast("string")).when(c("id") % 5 == 1, F.to_json(F.struct("id", "name"))).otherwise(" ")
    firms.filter("id % 5 < 3").select(line.alias("value")).write.text(path)
    return io.select_by_id_list(firms, io.read_id_list(spark, path)).select("id", "name")


@R.add("a6_write_export", "select cast(id as varchar) as id, name, plz from v_companies", ("v_companies",))
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    io.write_export(fixture(spark, sf_dir, "v_companies"), path, ("id", "name", "plz"), ("name", "id"))
    return io.read_master_csv(spark, path)


R.alias("a6_write_export_all", "a6_write_export")  # the second name of a query that once took every other company


