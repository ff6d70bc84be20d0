import random

from siltstone.operators.heavy_keys import counts_and_quantiles


def expect(rows, p):
    out = {}
    for k in {r[0] for r in rows if r[0] is not None}:
        vs = sorted(r[1] for r in rows if r[0] == k and r[1] is not None)
        out[k] = vs[max(1, -(-len(vs) * p // 100)) - 1] if vs else None
    return out


def test_quantiles_are_exact(spark):
    rng = random.Random(5)
    # one key holds a third, values tie, range beyond one digit, negatives
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.choice([rng.randrange(-(10**12), 10**12), 7, None])) for i in range(3000)] + [(None, 5), ("void", None)]
    df = spark.createDataFrame(rows, "key string, v long")
    got = {r["key_value"]: r for r in counts_and_quantiles(df, ("key",), "v", (0, 25, 50, 90, 100)).collect()}
    for p in (0, 25, 50, 90, 100):
        assert {k: r[f"q{p}"] for k, r in got.items()} == expect(rows, p)
    assert got["hot"]["n"] == 1000 and {r["total"] for r in got.values()} == {3002}


def test_edges(spark):
    empty = spark.createDataFrame([], "key string, v long")
    assert counts_and_quantiles(empty, ("key",), "v").count() == 0
    nulls = spark.createDataFrame([("a", None), (None, None)], "key string, v long")
    r = counts_and_quantiles(nulls, ("key",), "v").collect()
    assert [(x["key_value"], x["n"], x["q50"]) for x in r] == [("a", 1, None)]
    one = spark.createDataFrame([("a", 3, "x", 1)] * 4, "key string, v long, field string, c int")
    assert counts_and_quantiles(one, ("key",), "v").first()["q90"] == 3


def test_nothing_that_grows_is_broadcast(spark, small):
    """The one broadcast is the total of each key column."""
    from siltstone.plans import feed_problems

    plan = feed_problems.queries()["p6_quantiles"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "SortMergeJoin" in plan
