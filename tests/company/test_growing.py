"""Reads of a table that grows meanwhile, from a database in memory and from Parquet."""

import pytest
from pyspark.sql import functions as F

from prospectspark.sources import io

URL = "jdbc:derby:memory:growing;create=true"


@pytest.fixture
def database(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver")
    except Exception:  # the driver isn't part of every installation
        pytest.skip("no embedded database")
    connection = spark._jvm.java.sql.DriverManager.getConnection(URL)
    run = connection.createStatement().executeUpdate
    run("create table t (id bigint, name varchar(20))")
    yield run
    run("drop table t")
    connection.close()


def insert(run, keys):
    keys = list(keys)
    for a in range(0, len(keys), 200):
        run("insert into t values " + ", ".join(f"({k}, 'n{k}')" for k in keys[a : a + 200]))


def test_rows_that_come_later_stay_out_and_splits_are_even(spark, database):
    # most keys lie close together, a few far away
    keys = [*range(1, 901), *range(10_000_000, 10_000_100)]
    insert(database, keys)
    df = io.read_while_growing(spark, "t", "id", 5, url=URL)
    insert(database, [10_000_200, 20_000_000])
    assert sorted(r.ID for r in df.collect()) == keys
    insert(database, [10_000_201])
    assert df.count() == len(keys)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 2 * min(sizes)


def test_empty_and_single_key(spark, database):
    assert io.read_while_growing(spark, "t", "id", 4, url=URL).collect() == []
    insert(database, [7])
    assert [r.NAME for r in io.read_while_growing(spark, "t", "id", 4, url=URL).collect()] == ["n7"]


def test_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).write.parquet(path)
    df = io.read_while_growing(spark, path, "id")
    spark.range(50, 60).write.mode("append").parquet(path)
    assert df.count() == 50
    assert io.split_points(spark.range(100), "id", 1) == []
