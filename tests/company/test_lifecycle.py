from prospectspark.streaming import lifecycle

DAY = "2024-01-{:02d} 0{}:00:00"


def rows(df):
    return sorted((r.refnr, r.event, str(r["at"]), str(r.first_seen), str(r.last_seen), r.n) for r in df.collect())


def run(spark, tmp_path, parts, quiet, delay):
    """Each part is a file and a run of its own; returns the events and the state rows after each run."""
    state = []
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, "refnr string, d string").selectExpr("refnr", "cast(d as timestamp) as ts")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        with lifecycle.rocksdb_state(spark):
            out = lifecycle.stream_lifecycle(stream, quiet, delay)
            query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            query.awaitTermination()
        assert query.exception() is None
        state.append([p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators][-1])
    return spark.read.parquet(str(tmp_path / "out")), state


def test_stopped_stream_gives_the_events_of_the_whole_table(spark, tmp_path):
    before = spark.conf.get(lifecycle.PROVIDER, None)
    parts = [
        [("a", DAY.format(1, 1)), ("b", DAY.format(2, 1)), ("b", DAY.format(1, 5)), (None, DAY.format(1, 1)), ("c", None)],
        [("a", DAY.format(3, 1)), ("c", DAY.format(2, 7)), ("a", DAY.format(3, 0))],  # c comes late, a out of order
        [("b", DAY.format(9, 1)), ("d", DAY.format(9, 2))],
        [("e", DAY.format(20, 1))],
    ]
    found, _ = run(spark, tmp_path, parts, 3, "2 days")
    whole = spark.createDataFrame([r for p in parts for r in p], "refnr string, d string").selectExpr("refnr", "cast(d as timestamp) as ts")
    want = rows(lifecycle.batch_lifecycle(whole, 3))
    assert rows(found) == want and len(want) == 11
    assert spark.conf.get(lifecycle.PROVIDER, None) == before


def test_state_holds_the_open_ones_only(spark, tmp_path):
    parts = [[(f"{day}-{i}", DAY.format(day, 1)) for i in range(30)] for day in range(1, 9)]
    found, state = run(spark, tmp_path, parts, 2, "0 seconds")
    assert found.filter("event = 'appeared'").count() == 240 and found.filter("event = 'gone'").count() >= 150
    # a value and a timer for each open one, on days that the quiet time covers
    assert max(state[3:]) <= state[2] * 1.5
