import random

from siltstone.llm import encoding_em as em

WORDS = ["größe", "crème", "peñol", "łodka", "říman", "морена", "ветрол", "Берёзок", "ψαρολ", "θαλμα", "しおさい", "ハナテル", "smørre", "ação", "IRMÃ", "niño¿", "¡vale"]
WAYS = [("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "cp437"), ("utf-8", "koi8-r"), ("cp1251", "cp1252"), ("cp1253", "cp1252")]


def garble(word, written, read):
    try:
        out = word.encode(written).decode(read)
    except UnicodeError:
        return None
    return out if out != word else None


def rows_of(rng, n):
    clean, bad = [], []
    for i in range(n):
        w = rng.choice(WORDS)
        g = garble(w, *rng.choice(WAYS)) if rng.random() < 0.15 else None
        value = "ab" + (g or w) + ".x" + str(i)
        (bad if g else clean).append((i, f"s{i % 5}", value, "ab" + w + ".x" + str(i)))
    return clean, bad


def test_finds_and_restores(spark):
    clean, bad = rows_of(random.Random(2), 3000)
    df = spark.createDataFrame([r[:3] for r in clean + bad], "id long, source string, name string")
    got = {r["record_id"]: r["restored"] for r in em.garbled([(df, "t", ("name",), "source")]).collect()}
    want = {r[0]: r[3] for r in bad}
    assert len(got.keys() & want.keys()) >= 0.97 * len(want)
    assert len(got.keys() - want.keys()) <= 0.01 * len(clean)
    assert sum(got[k] == want[k] for k in got.keys() & want.keys()) >= 0.95 * len(want)


def test_partial_and_lost(spark):
    base = [(100 + i, "s", f"größe{i}") for i in range(300)]
    rows = [(1, "s", "größe-grÃ¶Ã\x9fe"), (2, "s", "gr��e"), (3, None, "grÃ¶Ã\x9fe"), (4, "s", "plain"), (5, "s", None), (6, "s", ""), (7, "s", "x" * 50_000 + "grÃ¶Ã\x9fe" + "größe " * 5_000), (8, "s", "name\xa0")]
    df = spark.createDataFrame(rows + base, "id long, source string, name string").selectExpr("*", "1 as field", "2 as record_id", "3 as weights")
    got = {r["record_id"]: (r["restored"], r["complete"]) for r in em.garbled([(df, "t", ("name",), "source")]).collect()}
    assert set(got) == {1, 2, 3, 7}
    assert got[1] == ("größe-größe", True) and got[2][1] is False and got[7][0] == "x" * 50_000 + "größe" + "größe " * 5_000


def test_empty(spark):
    df = spark.createDataFrame([], "id long, source string, name string")
    assert em.garbled([(df, "t", ("name",), "source")]).count() == 0


def test_nothing_unassigned():
    assert all(em._written(c) for _, text in em.candidates("Берёзок") for c in text)
