from prospectspark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def pairs(df):
    return {(r.refnr, r.company_id): (r.match_stufe, r.match_score) for r in df.collect()}


def test_all_stages_reach_the_queries(spark):
    best = pairs(QUERIES["e10_match_postings"](spark, SF))
    assert pairs(QUERIES["e10_best_match"](spark, SF)) == best and {s for s, _ in best.values()} == {"exakt", "fuzzy", "region", "fuzzy_grenzfall"}
    flagship = pairs(QUERIES["flagship_leading_roles"](spark, SF))
    titles = {r.refnr for r in QUERIES["e3_title_filter"](spark, SF).collect()}
    assert flagship == {k: v for k, v in best.items() if k[0] in titles}
    deduped = pairs(QUERIES["e12_dedupe_reposts"](spark, SF))
    assert deduped.items() <= best.items() and "fuzzy_grenzfall" in {s for s, _ in deduped.values()}


def test_bounds_lose_no_pair(spark):
    """Every pair of names in a block that reaches the score comes out, with the place left out, repeated letters and tokens included."""
    import random

    from prospectspark.functions.helpers import token_similarity
    from prospectspark.operators import signals

    rng = random.Random(3)
    words = ["ab", "abc", "aab", "neustadt", "kontor", "kontur", "werk", "werke", "x", "y2", "nord", "nordd"]
    names = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(120)})
    ads = spark.createDataFrame([(f"R{i}", n, "10001", "neustadt") for i, n in enumerate(names)], "refnr string, employer string, plz string, place string")
    firms = spark.createDataFrame([(i, n, "10001") for i, n in enumerate(names)], "id long, company string, plz string")

    def bare(n):
        return " ".join(t for t in n.split() if t != "neustadt") or n

    for least in (75, 95):
        want = {(a, b, token_similarity(bare(a), bare(b))) for a in names for b in names if a != b and token_similarity(bare(a), bare(b)) >= least}
        got = {(r.employer, r.company, r.score) for r in signals.similar_names(ads, firms, "plz", least).collect()}
        assert got == want
