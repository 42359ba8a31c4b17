"""Tables that are changed in parts, and matches that are kept up from changes."""

import os
import random

from pyspark.sql import functions as F

from prospectspark.operators import keyed, outreach, signals
from prospectspark.operators.keyed_table import KeyedTable
from prospectspark.streaming import streams

c = F.col


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    return {os.path.join(os.path.relpath(d, path), f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 16)
    old = spark.range(400).select("id", F.lit("old").alias("v"), (c("id") * 2).alias("w"))
    table.create(old)
    before = files(table.path)
    new = spark.createDataFrame([(5, "new"), (500, "new")], "id long, v string")
    rule = lambda a, b: keyed.upsert(a, b, ["id"])
    table.merge(new, 0, rule)
    after, once = files(table.path), rows(table.rows().select("id", "v", "w"))
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2
    assert once == rows(keyed.upsert(old, new, ["id"]).select("id", "v", "w"))
    table.merge(new, 0, rule)
    assert rows(table.rows().select("id", "v", "w")) == once
    table.merge(new.limit(0), 1, rule)
    assert rows(table.rows().select("id", "v", "w")) == once


def test_a_batch_that_was_cut_off_is_finished_by_its_repetition(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("k",), 4)
    add = lambda a, b: a.unionByName(b).groupBy("k").agg(F.sum("n").alias("n"))
    batch = lambda *ks: spark.createDataFrame([(k, 1) for k in ks], "k string, n long")
    table.merge(batch("a", "b", None), 0, add)
    table.merge(batch("b", "c"), 1, add)
    # as if the move into the table had stopped half way: a partition is lost, the batch comes again
    for folder in tmp_path.glob("t/bucket=*"):
        if spark.read.parquet(str(folder)).filter("k in ('b', 'c')").count():
            for f in folder.iterdir():
                f.unlink()
            break
    table.merge(batch("b", "c"), 1, add)
    assert rows(table.rows()) == sorted([("a", 1), ("b", 2), ("c", 1), (None, 1)], key=str)


def test_stream_goes_on_after_a_stop(spark, tmp_path):
    df = spark.createDataFrame([(f"R{i % 9}", f"2024-01-{1 + (i * 7) % 28:02d} 00:00:00") for i in range(90)], "refnr string, d string").select("refnr", c("d").cast("timestamp").alias("ts"))
    want = rows(streams.sightings(df))
    parts = df.randomSplit([0.3, 0.4, 0.3], 1)
    for part in parts:  # late and out of order; each part is a run of its own
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        query = streams.stream_sightings(stream, str(tmp_path / "out"), str(tmp_path / "state"), buckets=4)
        query.awaitTermination()
        assert not any(p.stateOperators for p in query.recentProgress)
    assert rows(KeyedTable(spark, str(tmp_path / "out"), ("refnr",), 4).rows()) == want


def test_a_wave_is_written_alone(spark, tmp_path):
    path = str(tmp_path / "r")
    reviews = spark.createDataFrame([(i, 1 + i % 3, "lead" if i % 2 else None, False, "" if i % 4 else "n") for i in range(30)], "company_id long, wave int, decision string, selected boolean, note_self string")
    reviews.write.partitionBy("wave").parquet(path)
    before = files(path)
    outreach.write_wave(path, reviews.filter("company_id < 9"), 2)
    cols = ["company_id", "wave", "decision", "selected", "note_self"]
    assert rows(spark.read.parquet(path).select(cols)) == rows(outreach.merge_reviews(reviews, reviews.filter("company_id < 9"), 2).select(cols))
    assert {f for f in before if "wave=2" not in f} == {f for f in files(path) if "wave=2" not in f}
    outreach.write_wave(path, reviews.limit(0), 2)
    assert spark.read.parquet(path).filter("wave = 2").count() == 0


def test_letters_that_were_sent_keep_their_day(spark):
    df = spark.createDataFrame([(1, "letter", 2, "queued", None), (2, "letter", 2, "sent", "2024-01-01"), (3, "letter", None, "queued", "2023-01-01")], "id int, channel string, wave int, status string, sent_at string").withColumn("sent_at", c("sent_at").cast("date"))
    assert [str(r.sent_at) for r in outreach.mark_sent(df, 2, "2024-02-02").orderBy("id").collect()] == ["2024-02-02", "2024-01-01", "2023-01-01"]
    assert [str(r.sent_at) for r in outreach.mark_sent(df.drop("sent_at"), 2, "2024-02-02").orderBy("id").collect()] == ["2024-02-02", "None", "None"]


def test_matches_from_changes_equal_matches_from_all(spark):
    rng = random.Random(7)
    words, plzs = ["alpha", "alfa", "beta", "bau", "werk", "werke", "nord", "süd"], ["10001", "10002", "10111", "20001", "20099", ""]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) + rng.choice([" GmbH", " AG", ""])
    ads = {f"R{i}": (name(), rng.choice(plzs), rng.choice(["Nordstadt", "Ulm"])) for i in range(60)}
    firms = {i: (name(), rng.choice(plzs), rng.choice([None, None, 3]), rng.choice([None, 60, 40])) for i in range(60)}

    def frames(ads, firms):
        schema = "refnr string, arbeitgeber string, plz string, ort string, places array<struct<plz:string,ort:string>>"
        a = spark.createDataFrame([(k, n, p, o, [(p, o), ("20001", "Ulm")] if k.endswith("3") else [(p, o)]) for k, (n, p, o) in ads.items()], schema)
        f = spark.createDataFrame([(k, *v) for k, v in firms.items()], "id long, name string, plz string, dup_of long, gf_alter int")
        return a, f

    old = frames(ads, firms)
    carried = signals.match_postings(*old)
    for k in rng.sample(sorted(ads), 12):
        ads[k] = (name(), rng.choice(plzs), "Ulm") if rng.random() < 0.6 else ads.pop(k)
    for k in rng.sample(sorted(firms), 12):
        firms[k] = (name(), rng.choice(plzs), None, 70) if rng.random() < 0.6 else firms.pop(k)
    ads |= {f"N{i}": (name(), rng.choice(plzs), "Nordstadt") for i in range(5)}
    firms |= {100 + i: (name(), rng.choice(plzs), None, 50) for i in range(5)}
    new = frames(ads, firms)
    got = signals.match_changes(*new, signals.ad_prints(old[0]), signals.company_prints(old[1]), carried)
    want = rows(signals.match_postings(*new))
    assert rows(got.select("refnr", "company_id", "match_stufe", "match_score", "gf_alter")) == want and len(want) > 50
    unchanged = signals.match_changes(*new, signals.ad_prints(new[0]), signals.company_prints(new[1]), got)
    assert rows(unchanged.select("refnr", "company_id", "match_stufe", "match_score", "gf_alter")) == want
