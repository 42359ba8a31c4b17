"""The queries over all rows equal their SQL."""

import pytest

from prospectspark.plans.queries import ORACLE_SQL, QUERIES

from .test_queries import SF, oracle  # noqa: F401


@pytest.mark.parametrize("name", ["a6_write_export_all", "f9_persist_pages_all", "f10_flag_no_text_all", "i8_funnel_kpis_all", "i9_work_list_all"])
def test_query_equals_sql(spark, oracle, name):  # noqa: F811
    df = QUERIES[name](spark, SF)
    found = oracle.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, found.fetchall())) and got
