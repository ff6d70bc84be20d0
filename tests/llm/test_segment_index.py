import random

import pytest
from pyspark.sql import functions as F

from siltstone.llm import segment_index as si

DDL = "id long, batch_id int, domain string, username string, password string, credential_hash string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def text(r):
    return " ".join(x or "" for x in r[2:5]).lower()


def brute(rows):
    out = set()
    rows = [r for r in rows if r[5] is not None]
    for r in rows:
        for s in rows:
            if s[1] < r[1] and (s[5] == r[5] or distance(text(r), text(s)) <= 3):
                out.add(r[0])
                break
    return out


def edited(rng, s, n):
    for _ in range(n):
        i = rng.randrange(len(s) + 1)
        s = rng.choice([s[:i] + rng.choice("abxé ") + s[i:], s[:i] + s[i + 1 :], s[:i] + rng.choice("yz9") + s[i + 1 :]])
    return s


def rows_with(rng, n):
    """Short and long texts, a host held by a third of all, copies and edits of one to five characters."""
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            old = rng.choice(rows)
            u, p = edited(rng, old[3] or "", rng.randrange(4)), edited(rng, old[4] or "", rng.randrange(3))
            d = edited(rng, old[2] or "", rng.randrange(2))
        else:
            d = rng.choice(["portal.hot.example", f"h{rng.randrange(50)}.test", "", None])
            u, p = rng.choice([None, "", "Ab", "user%d@mail.example" % rng.randrange(999)]), "".join(rng.choice("abc123") for _ in range(rng.choice([0, 1, 3, 12, 40])))
        rows.append((i + 1, 1 + i * 6 // n, d, u, p, None if rng.random() < 0.03 else f"{d}|{u}|{p}"))
    return rows


@pytest.mark.parametrize("hot, steps", [(1, 2), (32, 1)])
def test_equals_brute_force(spark, monkeypatch, hot, steps):
    monkeypatch.setattr(si, "HOT_LEAST", hot)
    rows = rows_with(random.Random(hot), 220)
    got = {r["id"] for r in si.repeats(spark.createDataFrame(rows, DDL), steps).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("buckets", [2, 4000])
def test_batch_by_batch(spark, buckets):
    """With few buckets no key counts as heavy, with very many every hot key does."""
    rows = rows_with(random.Random(9), 150)
    df = si.prepared(spark.createDataFrame(rows, DDL))
    index, got = si.SegmentIndex(spark, least=2), set()
    index.buckets = buckets
    for batches in ((1,), (2, 3), (4, 5, 6)):
        got |= {r["id"] for r in index.add(df.filter(F.col("batch").isin(*batches))).collect()}
        if batches == (2, 3) and buckets == 2:
            index.compact()
    assert got == brute(rows)
    assert bool(index.heavy[0]) == (buckets == 4000)


def test_history_is_not_shuffled(spark):
    df = si.prepared(spark.createDataFrame(rows_with(random.Random(3), 60), DDL))
    index = si.SegmentIndex(spark, buckets=3)
    index.add(df.filter("batch < 5"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = si.materialise(si.distinct_texts(df.filter("batch = 5")), "fresh")
        plan = index._met(lambda only=None: si._spread(fresh, "tid", True, only), index.entries[0], set())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange, that of the batch's own look-ups
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_edges(spark):
    empty = spark.createDataFrame([], DDL)
    assert si.repeats(empty).count() == 0
    rows = [(1, 1, None, None, None, "a"), (2, 2, None, None, None, "b"), (3, 2, "x" * 20_000, None, "p", "c"), (4, 3, "x" * 20_000, "q", "p", "d"), (5, None, "x", "y", "z", "e"), (6, 3, "other", "name", "word", "a"), (7, 4, "one", "two", "three", None), (8, 5, "one", "two", "three", "f")]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as tid", "2 as text", "3 as since")
    assert {r["id"]: r["exact"] for r in si.repeats(df).collect()} == {2: False, 4: False, 6: True}
