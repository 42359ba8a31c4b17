"""Quotes and texts meet without sending either to all tasks."""

from prospectspark.operators import evidence


def test_no_side_is_broadcast_and_many_anchors_lose_no_quote(spark):
    # more anchors of one company than its filter has bits
    body = " ".join(f"w{i} x{i}" for i in range(1500))
    words = body.split()
    quotes = [(1, " ".join(words[i : i + 7])) for i in range(0, 2900, 2)] + [(1, "w1 x1 w3 x3"), (2, "w0 x0 w1"), (2, "nothing of it")]
    df = spark.createDataFrame(quotes, "company_id int, zitat string")
    texts = spark.createDataFrame([(1, body), (2, "a w0 x0 w1"), (3, "w0 x0")], "company_id int, body string")
    found = evidence.quote_fidelity(df, texts)
    assert sorted(map(tuple, found.collect())) == [(1, 1451, 1450), (2, 2, 1)]
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
