import random

from pyspark.sql import functions as F

from prospectspark.operators import outreach, search, similar

c = F.col


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keys_meet_texts_by_their_anchors(spark):
    rng = random.Random(2)
    piece = lambda n: "".join(rng.choice("abAB ß.") for _ in range(n))
    texts = [(i, piece(rng.randint(0, 14))) for i in range(120)] + [(500, None), (501, "")]
    keys = [(i, piece(rng.randint(0, 6)), f"v{i}") for i in range(60)] + [(90, None, "x"), (91, "", "all")]
    t, k = spark.createDataFrame(texts, "id int, name string"), spark.createDataFrame(keys, "ord int, key string, value string")
    want = sorted((i, min((o, v) for o, key, v in keys if key is not None and key in n)[1]) for i, n in texts if n is not None)
    assert sorted(tuple(r) for r in outreach.apply_by_substring(t, k).collect()) == want
    assert outreach.apply_by_substring(t, k.limit(0)).collect() == []


def test_many_keys_need_no_nested_loop(spark):
    texts = spark.range(200).select("id", F.concat(F.lit("Firma "), F.sha2(c("id").cast("string"), 256)).alias("name"))
    keys = spark.range(100_000).select(c("id").cast("int").alias("ord"), F.substring(F.sha2(c("id").cast("string"), 256), 5, 12).alias("key"), F.lit("v").alias("value"))
    out = outreach.apply_by_substring(texts, keys)
    assert out.count() == 200
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_shared_names_meet_the_keys_once(spark):
    """A name that many companies have meets a key that many overrides have once, and no side is sent whole to all tasks."""
    texts = spark.range(3000).select("id", F.concat(F.lit("ivory ring "), (c("id") % 3).cast("string")).alias("name"))
    keys = spark.range(2000).select(c("id").cast("int").alias("ord"), F.when(c("id") % 2 == 0, "ring 1").otherwise("ivory").alias("key"), c("id").cast("string").alias("value"))
    out = outreach.apply_by_substring(texts, keys)
    assert {tuple(r) for r in out.groupBy("value").count().collect()} == {("0", 1000), ("1", 2000)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    names, firsts = texts.select("name").distinct(), keys.groupBy("key").agg(F.min("ord").alias("ord"))
    assert search.containing(names, "name", firsts, "key").count() == 4


def test_letters_of_a_shared_name_are_counted_before_they_meet(spark):
    firms = spark.createDataFrame([(i, "a" if i < 40 else None if i == 40 else f"b{i}") for i in range(45)] + [(None, "b41")], "id int, name string")
    letters = spark.createDataFrame([("a",)] * 30 + [("b41",), ("b42",), ("c",), (None,)], "name string")
    selection = spark.createDataFrame([(w, i, "lead", False) for i in range(10) for w in (1, 2)] + [(42, 42, None, True)], "wave int, company_id int, decision string, selected boolean")
    out = outreach.reconcile_letters(letters, firms, selection)
    assert dict(out.collect()) == {"lead": 301, "dropped": 901, "unmatched": 3}
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line]
    assert "Aggregate" in out._jdf.queryExecution().optimizedPlan().toString().split(joins[0])[1].split("\n")[1]


def test_index_equals_the_scan(spark, tmp_path):
    rng = random.Random(4)
    words = ["Leiter", "Werk", "GmbH", "Süd", "ab", "x"]
    df = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))) for i in range(200)] + [(900, None)], "id int, t string")
    search.write_index(df, "id", c("t"), str(tmp_path / "i"))
    index = spark.read.parquet(str(tmp_path / "i"))
    for asked in (["leiter"], ["LEIT", "süd"], ["ab"], ["x", "werk"], [], ["nowhere"], ["iter w"]):
        want = [r.id for r in df.orderBy("id").collect() if all(w.lower() in (r.t or "").lower() for w in asked)]
        assert [r.id for r in search.search(df, "id", c("t"), index, asked).orderBy("id").collect()] == want
    assert "PartitionFilters: [part" in search.candidates(index, "id", ["leiter"])._jdf.queryExecution().toString()


def blocks_of(spark, n, rng):
    words = ["".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(3, 9))) for _ in range(n)]
    name = lambda: " ".join(rng.choice(words) for _ in range(3))
    a, b = {name() for _ in range(n)}, {name() for _ in range(n)}
    a |= {x[:-1] + "x" for x in list(b)[: n // 10]}
    make = lambda s: spark.createDataFrame([("1", x) for x in sorted(s)], "plz string, name string")
    return a, b, make(a), make(b)


def test_index_finds_all_and_grows_with_the_table(spark):
    from prospectspark.functions.helpers import token_similarity

    met = {}
    for n in (150, 300, 600):
        a, b, x, y = blocks_of(spark, n, random.Random(n))
        x, y = similar.parts_of(x), similar.parts_of(y)
        for least in (75, 95):
            pairs = {(r.a, r.b) for r in similar.indexed_pairs(x, y, "plz", least).collect()}
            if n == 150:
                assert {(p, q) for p in a for q in b if token_similarity(p, q) >= least} <= pairs
            met[least, n] = len(pairs)
    # names of one block that is twice as large: far fewer than all pairs, which would be four times as many
    assert met[95, 600] <= 3 * met[95, 300] and met[95, 600] < 0.05 * 600 * 600


def test_rated_pairs_with_and_without_index(spark):
    _, _, x, y = blocks_of(spark, 120, random.Random(1))
    x, y = similar.parts_of(x), similar.parts_of(y)
    for least in (75, 95):
        indexed = rows(similar.rated_pairs(x, y, "plz", least, few=0).select("a", "b", "score"))
        assert indexed == rows(similar.rated_pairs(x, y, "plz", least, few=10_000).select("a", "b", "score")) and indexed
