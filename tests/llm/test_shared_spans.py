import random

import numpy as np
import pytest

from siltstone.llm import fm_index
from siltstone.llm import shared_spans as ss

DDL = "doc_id long, text string"


def brute(docs, least):
    held = {}
    for i, t in docs:
        for k in range(len(t or "") - least + 1):
            held.setdefault(t[k : k + least], set()).add(i)
    out = set()
    for s in held.values():
        s = sorted(x for x in s if x is not None)
        out |= {(a, b) for k, a in enumerate(s) for b in s[k + 1 :]}
    return out


def covered(docs, least):
    held = {}
    for i, t in docs:
        for k in range(len(t or "") - least + 1):
            held.setdefault(t[k : k + least], set()).add(i)
    out = {}
    for i, t in docs:
        places = set()
        for k in range(len(t or "") - least + 1):
            if len(held[t[k : k + least]]) > 1:
                places |= set(range(k, k + least))
        if places:
            out[i] = len(places)
    return out


def sample(rng, n=60):
    pool = ["".join(rng.choice("abcdéあ \n") for _ in range(rng.choice([330, 320, 319, 500, 1200]))) for _ in range(12)] + ["ab" * 400, "x" * 700]
    docs = []
    for i in range(n):
        parts = ["".join(rng.choice("efgh") for _ in range(rng.randrange(300))) for _ in range(3)]
        for k in range(rng.randrange(3)):
            p = rng.choice(pool)
            cut = rng.choice([0, 0, 5, 40])
            parts.insert(rng.randrange(len(parts) + 1), p[cut:])
        docs.append((i, "".join(parts)))
    return docs + [(n, docs[1][1]), (n + 1, docs[2][1]), (n + 2, docs[2][1])]


def test_pieces_have_all_anchors(monkeypatch):
    monkeypatch.setattr(ss, "PIECE_CHARS", 1_000)
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (5_000, 319, 320, 1_000, 999, 1_320, 2_000)]

    def places(parts):
        out = set()
        for lot in parts:
            text, h, first, last = ss.anchors(*ss.code_points([p for _, _, p in lot]))
            out |= {(lot[t][0], int(x), lot[t][1] + int(a), lot[t][1] + int(b)) for t, x, a, b in zip(text, h, first, last)}
        return out

    assert places(ss._pieces(texts, 319)) == places([[(k, 0, t) for k, t in enumerate(texts)]])


@pytest.mark.parametrize("seed,chars", [(0, ss.SHARD_CHARS), (1, 900)])
def test_pairs_equal_brute_force(spark, seed, chars):
    docs = sample(random.Random(seed))
    got = {tuple(r) for r in ss.sharing_pairs(spark.createDataFrame(docs, DDL).repartition(3), shard_chars=chars).collect()}
    assert got == brute(docs, 320)


@pytest.mark.parametrize("chars, piece", [(ss.SHARD_CHARS, ss.REGION_CHARS), (900, 150)])
def test_share_equals_brute_force(spark, monkeypatch, chars, piece):
    """In one shard; and with groups cut up, regions in pieces."""
    monkeypatch.setattr(ss, "REGION_CHARS", piece)
    docs = sample(random.Random(5))
    got = {r["doc_id"]: r["shared_chars"] for r in ss.shared_share(spark.createDataFrame(docs, DDL), shard_chars=chars).collect()}
    assert got == covered(docs, 320)


def test_intervals_are_united():
    doc, begin, end = ss._united(*map(np.array, ([2, 1, 1, 1, 2], [5, 0, 3, 20, 7], [9, 4, 10, 25, 8])))
    assert list(zip(doc, begin, end)) == [(1, 0, 10), (1, 20, 25), (2, 5, 9)]


def test_edges(spark):
    line = "".join(random.Random(1).choice("abcdef ") for _ in range(320))
    docs = [(1, None), (2, ""), (3, line), (4, line[:-1]), (5, "z" * 200_000 + line), (3, line), (None, line), (6, line + line), (7, "q" * 1_000 + "r" + "q" * 1_000)]
    df = spark.createDataFrame(docs, DDL).selectExpr("*", "1 as doc", "2 as h", "3 as grp")
    assert {tuple(r) for r in ss.sharing_pairs(df).collect()} == {(3, 5), (3, 6), (5, 6)}
    assert ss.sharing_pairs(df.limit(0)).count() == 0
    assert ss.shared_share(df.limit(0)).count() == 0


def test_fm_index_counts_and_locates():
    rng = random.Random(2)
    text = "".join(rng.choice("abc") for _ in range(500))
    codes = np.array([ord(c) - 95 for c in text] + [0])
    index = fm_index.FMIndex(codes)
    assert [text[i:] for i in index.locate(np.arange(1, 501))] == sorted(text[i:] for i in range(len(text)))
    assert len(index.places) == 500 // fm_index.RATE + 1
    starts = np.arange(0, 480, 7)
    which, low, high = index.search(codes, starts, 6)
    assert list(which) == list(range(len(starts)))
    for w, lo, hi in zip(which, low, high):
        p = text[starts[w] : starts[w] + 6]
        assert sorted(index.locate(np.arange(lo, hi))) == [i for i in range(495) if text.startswith(p, i)]


def test_anchors_are_shared():
    rng = random.Random(3)
    for _ in range(30):
        span = "".join(rng.choice("ab") for _ in range(320))
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(400))) + span + "".join(rng.choice("ab") for _ in range(rng.randrange(400))) for _ in range(2)]
        text, h, first, last = ss.anchors(*ss.code_points(texts))
        inside = []
        for k in range(2):
            at = texts[k].index(span)
            inside.append({int(x) for x, t, a, b in zip(h, text, first, last) if t == k and b >= at and a + ss.GRAM <= at + 320})
        assert inside[0] & inside[1]
