"""Every query on the company data runs at the smallest size and names its columns as its SQL does."""

import duckdb
import pytest

from prospectspark.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["flagship_leading_roles", "b8_parse_german_number", "c5_mark_duplicates", "c6_enrich_directors", "b19_token_set_ratio", "e8_match_fuzzy", "e9_match_region", "e10_best_match", "e12_dedupe_reposts", "e14_insert_matches", "e15_reconcile_matches", "e15_rematch", "e17_signal_counts", "e19_open_reposts", "a7_keyed_table", "d1_unify_job_sources", "d2_external_id", "e21_indexed_search", "f4_classify_links", "f5_select_pages", "f7_modernity_score", "f9_persist_pages", "f13_crawl_counts", "g5_quote_fidelity", "i2_curation_frame", "i5_write_wave", "i10_mark_sent", "i12_overrides_from_parts", "k1_lifecycle", "g2_assemble_context", "h1_score_companies", "i9_work_list", "j1_check_constraints", "k2_stream_dedupe"])
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    found = oracle.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
