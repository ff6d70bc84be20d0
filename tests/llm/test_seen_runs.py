import random

from siltstone.llm import seen_runs as sr


def brute(rows):
    first = {}
    for i, k in rows:
        if k is not None and i is not None:
            first[k] = min(i, first.get(k, i))
    return sorted(i for i, k in rows if k is not None and i is not None and i > first[k])


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", f"k{rng.randrange(60)}", None])) for i in range(1, 400)] + [(5, "twice"), (5, "twice"), (9, "twice"), (None, "hot")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, credential_hash string").selectExpr("*", "1 as h", "2 as key", "3 as first_id")
    for steps in (1, 3, 11):
        assert sorted(r["id"] for r in sr.seen_before(df, steps=steps).collect()) == brute(rows)


def test_levels_compact_and_stay_few(spark):
    seen = sr.SeenKeys(spark, fan=2, buckets=3)
    for b in range(9):
        seen.admit(spark.createDataFrame([(10 * b + i, f"{b}-{i}".encode()) for i in range(5)], "id long, key binary"))
    assert all(len(level) < 2 for level in seen.levels) and len(seen.levels) > 2
    assert seen.keys().count() == 45
    assert all(run["low"] <= run["high"] and len(run["blocks"]) <= run["rows"] for run in seen.runs())
    old = seen.firsts(spark.createDataFrame([(99, b"3-3"), (98, b"new")], "id long, key binary"))
    assert [r["key"] for r in seen.unseen(old).collect()] == [b"new"]


def _plan_of(seen, monkeypatch, firsts):
    plans = []
    with monkeypatch.context() as m:
        own = sr.materialise
        m.setattr(sr, "materialise", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or own(df, label))
        left = seen.unseen(firsts)
    return plans[-1], left


def test_small_batches_read_few_buckets(spark, monkeypatch):
    seen = sr.SeenKeys(spark, buckets=8)
    seen.admit(spark.createDataFrame([(i, f"{i}".encode()) for i in range(500)], "id long, key binary"))
    plan, left = _plan_of(seen, monkeypatch, seen.firsts(spark.createDataFrame([(900, b"7"), (901, b"new")], "id long, key binary")))
    assert "SelectedBucketsCount: 2 out of 8" in plan or "SelectedBucketsCount: 1 out of 8" in plan
    assert [r["key"] for r in left.collect()] == [b"new"]


def test_runs_without_a_block_of_the_batch_are_not_read(spark, monkeypatch):
    seen = sr.SeenKeys(spark, buckets=4)
    seen.admit(spark.createDataFrame([(1, b"a")], "id long, key binary"))
    block = next(iter(seen.runs()[0]["blocks"]))
    other = next(k for k in (f"{i}".encode() for i in range(99)) if spark.range(1).select(sr._slot(sr.F.xxhash64(sr.F.lit(k)))).first()[0] != block)
    plan, left = _plan_of(seen, monkeypatch, seen.firsts(spark.createDataFrame([(2, other)], "id long, key binary")))
    assert "Join" not in plan and left.count() == 1


def test_history_is_not_shuffled(spark, monkeypatch):
    seen = sr.SeenKeys(spark, buckets=4)
    for b in range(2):
        seen.admit(spark.createDataFrame([(1000 * b + i, f"{b}-{i}".encode()) for i in range(500)], "id long, key binary"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        firsts = sr.materialise(seen.firsts(spark.createDataFrame([(5000 + i, f"1-{2 * i}".encode()) for i in range(400)], "id long, key binary")), "firsts")
        plan, left = _plan_of(seen, monkeypatch, firsts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the one exchange is the batch's
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert left.count() == 150


def test_hash_hits_need_the_full_key(spark):
    from pyspark.sql import functions as F

    seen = sr.SeenKeys(spark, buckets=2)
    rows = spark.createDataFrame([(1, b"a")], "id long, key binary")
    seen.levels[0].append(seen._write(seen.firsts(rows).withColumn("h", F.lit(7).cast("long"))))
    other = seen.firsts(spark.createDataFrame([(2, b"b")], "id long, key binary")).withColumn("h", F.lit(7).cast("long"))
    assert seen.unseen(other).count() == 1
    h = seen.hits(other).first()
    assert (h["probed"], h["hash_hits"], h["confirmed"]) == (1, 1, 0)


def test_empty(spark):
    df = spark.createDataFrame([], "id long, credential_hash string")
    assert sr.seen_before(df).count() == 0 and sr.error_rate(df).count() == 0


def test_ranges_without_a_new_key(spark):
    # ranges of 25 ids: all keys are met in the first, the second has no row, the third only a null
    rows = [(1, "a"), (2, "b"), (3, "a"), (60, None), (76, "b"), (99, "a"), (100, "b")]
    df = spark.createDataFrame(rows, "id long, credential_hash string")
    assert sorted(r["id"] for r in sr.seen_before(df, steps=4).collect()) == brute(rows)
    assert tuple(sr.error_rate(df, steps=4).first()) == (4, 2, 2, 0.0, 0.0)
    nulls = df.withColumn("credential_hash", sr.F.lit(None).cast("string"))
    assert sr.seen_before(nulls, steps=4).count() == 0 and tuple(sr.error_rate(nulls, steps=4).first()) == (0, 0, 0, 0.0, 0.0)


def test_batches_without_a_new_key_leave_no_run(spark):
    seen = sr.SeenKeys(spark, fan=2, buckets=3)
    seen.admit(spark.createDataFrame([(1, b"a"), (2, b"b")], "id long, key binary"))
    for b in range(3):
        assert seen.admit(spark.createDataFrame([(10 + b, b"a")], "id long, key binary")).count() == 0
    assert len(seen.runs()) == 1 and len(seen.levels) == 1
    seen.admit(spark.createDataFrame([(20, b"b"), (21, b"c")], "id long, key binary"))
    assert sorted((r["key"], r["first_id"]) for r in seen.keys().collect()) == [(b"a", 1), (b"b", 2), (b"c", 21)]


def test_rate_counts_every_range(spark):
    # ranges of two ids: b is met again in the second, a in the third, c in the fourth
    rows = [(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "a"), (6, "d"), (7, "c"), (8, "e")]
    r = sr.error_rate(spark.createDataFrame(rows, "id long, credential_hash string"), steps=4).first()
    assert tuple(r) == (8, 3, 3, 0.0, 0.0)


def test_rate_counts_collisions_within_and_between_ranges(spark, monkeypatch):
    from pyspark.sql import functions as F

    own = sr.SeenKeys.firsts
    monkeypatch.setattr(sr.SeenKeys, "firsts", lambda self, batch: own(self, batch).withColumn("h", F.lit(7).cast("long")))
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "c")]
    r = sr.error_rate(spark.createDataFrame(rows, "id long, credential_hash string"), steps=2).first()
    # b meets a in its own range, c meets both in the one before, a is confirmed
    assert tuple(r) == (4, 3, 1, 2 / 3, 0.0)


def test_rate_after_the_check_is_measured(spark, monkeypatch):
    monkeypatch.setattr(sr.SeenKeys, "unseen", lambda self, firsts: firsts.filter("first_id <> 2"))
    r = sr.error_rate(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "id long, credential_hash string"), steps=2).first()
    # b was never stored, a was stored twice
    assert r["wrong_after_check"] == 2 / 4
