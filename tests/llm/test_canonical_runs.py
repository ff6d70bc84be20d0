import random
import re
from collections import Counter, defaultdict

import pytest

from siltstone.llm import canonical_runs as cr

DDL = "id long, url string, username string, password string"


def canon(r):
    return tuple(sorted(w.lower() for w in re.findall(r"[^\W_]+", f"{r[1] or ''} {r[2] or ''}"))), r[3] or ""


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            groups[canon(r)].append(r)
    pairs, copies = set(), Counter()
    for g in groups.values():
        g.sort(key=lambda r: r[0])
        copies[g[0][0]] = len(g)
        pairs |= {(g[0][0], r[0]) for r in g[1:] if r[1:3] != g[0][1:3]}
    return pairs, copies


def check(spark, rows):
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as canon", "2 as variant", "3 as part").repartition(5)
    pairs, _ = cr.scan_runs(df, ("url", "username"), "password")
    _, runs = cr.scan_runs(df, ("url", "username"), "password", runs=True)
    want_pairs, want_copies = brute(rows)
    assert {(r["first_id"], r["id"]) for r in pairs.filter("differs").collect()} == want_pairs
    assert {r["first_id"]: r["copies"] for r in runs.collect()} == dict(want_copies)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(1, 600):
        words = rng.choice([["hot", "user"], [f"h{rng.randrange(80)}", "ann"], ["a", "a"], []])
        rng.shuffle(words)
        written = rng.choice([" ", "/", "__", ".-"]).join(rng.choice([w, w.upper()]) for w in words)
        cut = rng.randrange(len(written) + 1) if not written.replace(" ", "").isalnum() else len(written)
        rows.append((i, written[:cut] or None, written[cut:], rng.choice(["p", "p", "q", None])))
    check(spark, rows)


def test_one_record_in_every_partition(spark):
    check(spark, [(i, "a/b" if i % 2 else "b a", "u", "p") for i in range(1, 2_000)] + [(5_000, "z", "z", "z")])


def test_edges(spark):
    check(spark, [(1, None, None, None), (2, "", "", ""), (3, "--", "__", None), (4, "x" * 100_000, "y", "p"), (5, "Y", "X" * 100_000, "p"), (None, "a", "b", "p")])
    empty = spark.createDataFrame([], DDL)
    pairs, runs = cr.scan_runs(empty, ("url", "username"), "password", runs=True)
    assert pairs.count() == 0 and runs.count() == 0
