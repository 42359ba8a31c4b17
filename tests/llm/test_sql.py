"""Queries of the newer corpus operators against their SQL at the smallest size."""

import duckdb
import pytest

from prospectspark.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_url_filter", "op11_spelling_variants", "op12_prefix_trie"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
