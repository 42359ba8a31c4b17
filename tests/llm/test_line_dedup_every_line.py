import re

import duckdb

from prospectspark.llm.line_dedup import keep_first_lines
from prospectspark.llm.registry import ORACLE_SQL, QUERIES

from .data import SCHEMA, random_documents
from .test_line_dedup import WORD, brute, variants


def test_short_lines_equal_brute_force_and_sql(spark, tmp_path):
    short = ["home", "home about", "about home", "a b c d", "a b c d e", "home home", ""]
    rows = variants(4) + [(d + 1000, *r) for d, *r in random_documents(4, 25) if d is not None]
    rows += [(3000 + i, "\n".join(short[i % 7 :] + short[: i % 5]), None, "s", 1) for i in range(100)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    got = sorted(map(tuple, QUERIES["op9_line_dedup_every_line"](spark, str(tmp_path)).collect()))
    stays = brute(rows, min_words=1)
    want = []
    for d, text, *_ in rows:
        n, kept = sum(bool(re.search(WORD, x)) for x in (text or "").split("\n")), sorted(stays.get(d, ()))
        want.append((d, n, n, n - len(kept), ",".join(map(str, kept))))
    assert got == sorted(want)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    assert got == sorted(con.execute(ORACLE_SQL["op9_line_dedup_every_line"]).fetchall())


def test_repeated_headings_go_and_blank_lines_stay(spark):
    rows = [(1, "menu\n\nfirst text", None, None, 1), (2, "menu\n\nsecond text", None, None, 1), (3, "menu", None, None, 1)]
    left = keep_first_lines(spark.createDataFrame(rows, SCHEMA), min_words=1)
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "menu\n\nfirst text"), (2, "\nsecond text")]
