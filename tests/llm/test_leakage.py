import random

from siltstone.llm import leakage as lk

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def brute(docs, items, n):
    out = set()
    for d, a in docs:
        for i, b in items:
            x, y = lk.words(a), lk.words(b)
            grams = {tuple(y[k : k + n]) for k in range(len(y) - n + 1)}
            if any(tuple(x[k : k + n]) in grams for k in range(len(x) - n + 1)):
                out.add((d, i))
    return out


def sample(rng):
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 20)))) for i in range(20)]
    docs = []
    for d in range(80):
        parts = ["".join(rng.choice("xyz ") for _ in range(20))]
        for _ in range(rng.randrange(4)):
            w = (rng.choice(items)[1]).split()
            k = rng.randrange(len(w))
            parts.append(rng.choice([" ", "-", "_", "\n"]).join(rng.choice([x, x.upper()]) for x in w[k : k + rng.randrange(1, 9)]))
        docs.append((d, " ".join(parts)))
    return docs, items


def test_equals_brute_force(spark, monkeypatch):
    for limit in (lk.ITEM_LIMIT, 100):
        monkeypatch.setattr(lk, "ITEM_LIMIT", limit)
        docs, items = sample(random.Random(3))
        got = lk.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 5).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == brute(docs, items, 5)


def test_cut_out_leaves_nothing(spark):
    docs, items = sample(random.Random(4))
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    left = lk.without_leaks(d, i, 5)
    clean = {r["doc_id"]: r["text"] for r in left.collect()}
    hit = {a for a, _ in brute(docs, items, 5)}
    assert len(clean) == len(docs) and all(clean[k] == t for k, t in docs if k not in hit)
    assert all(r["removed_words"] >= 5 for r in left.collect() if r["doc_id"] in hit)


def test_edges(spark):
    line = " ".join(f"t{i}" for i in range(13))
    docs = [(1, None), (2, ""), (3, line.upper()), (4, "x " * 100_000 + line), (5, line[:-4]), (3, line), (6, "İ " + line.replace(" ", "́_"))]
    items = [(1, line), (2, "short"), (3, None), (4, "pre " + line + " post")]
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as item_id", "2 as words_leaked")
    got = sorted((r["doc_id"], r["item_id"]) for r in lk.leaks(d, spark.createDataFrame(items, ITEMS)).collect())
    assert got == [(3, 1), (3, 4), (4, 1), (4, 4), (6, 1), (6, 4)]
    assert lk.leaks(d.limit(0), spark.createDataFrame(items, ITEMS)).count() == 0
    assert lk.leaks(d, spark.createDataFrame([], ITEMS)).count() == 0
    cut = {r["doc_id"]: r["text"] for r in lk.without_leaks(d, spark.createDataFrame(items, ITEMS)).collect()}
    assert cut[6] == "İ " and cut[5] == line[:-4] and cut[1] is None


def test_blocks_of_items_do_not_matter(spark, monkeypatch):
    # the second item overlaps the first in the document; cut one after another it would keep w5 w6
    docs = [(1, "x w1 w2 w3 w4 w5 w6 y"), (2, "w3 w4 z"), (3, None), (4, "a w1 w2 w3 w4 b")]
    items = [(1, "w1 w2 w3 w4"), (2, "w3 w4 w5 w6"), (3, "a b c d"), (4, "q r s t")]
    for limit in (lk.ITEM_LIMIT, 1):
        monkeypatch.setattr(lk, "ITEM_LIMIT", limit)
        left = lk.without_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS).coalesce(1), 4)
        got = {r["doc_id"]: (r["text"], r["removed_words"]) for r in left.collect()}
        assert got == {1: ("x  y", 6), 2: ("w3 w4 z", 0), 3: (None, 0), 4: ("a  b", 4)}
