from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.operators.repair_parse import _split, cheapest, parse_records, shape_of

GOOD = "https://a.test/x,bob,pw,App,Work,12,2020-02-29T10:00:00Z"


def brute(shape, fields):
    """Least cost by searching all texts reachable by so many edits."""

    def valid(s):
        f, mode, i = 0, "s", 0
        for c in s:
            if mode == "q":
                mode = "e" if c == "q" else "q"
            elif c == "c":
                f, mode = f + 1, "s"
            elif c == "q":
                if mode not in "se":
                    return False
                mode = "q"
            else:
                if mode == "e":
                    return False
                mode = "b"
            i += 1
        return f == fields - 1 and mode != "q"

    front, cost = {shape}, 0
    while not any(map(valid, front)):
        new = set()
        for s in front:
            for i in range(len(s) + 1):
                new |= {s[:i] + k + s[i:] for k in "qc"}
                if i < len(s) and s[i] in "qc":
                    new.add(s[:i] + s[i + 1 :])
        front, cost = new, cost + 1
    return cost


@pytest.mark.parametrize("shape", ["".join(p) for n in range(5) for p in product("qco", repeat=n) if "oo" not in "".join(p)])
def test_cost_is_least(shape):
    assert cheapest(shape, 2)[0] == brute(shape, 2)


def statuses(spark, texts):
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "source_file string, line_number int, raw_text string")
    return {r["line_number"]: r for r in parse_records(df).collect()}


def test_valid_forms(spark):
    texts = [GOOD, ",".join(f'"{x}"' for x in GOOD.split(",")), GOOD.replace("bob", '"a,b"'), GOOD.replace("bob", '"a\nb"'), GOOD.replace("bob", '"a""b"'), GOOD.replace("bob", ""), GOOD.replace("bob", '""')]
    got = statuses(spark, texts)
    assert [got[i]["status"] for i in range(len(texts))] == ["loaded"] * len(texts)
    assert [got[i]["username"] for i in range(len(texts))] == ["bob", "bob", "a,b", "a\nb", 'a"b', "", ""]
    assert all(len(got[i]["password_digest"]) == 64 for i in got)


def test_rejects_have_reasons(spark):
    bad = [None, "", "\t", GOOD + ",more", GOOD.replace("bob", 'b"ob'), GOOD.replace("bob", '"bob'), GOOD.replace("bob", '"closed"x'), GOOD.replace("https", "HTTPS"), GOOD.replace("https://a", "https:///a"), GOOD.replace(",12,", ",0,"), GOOD.replace(",12,", ",-1,"), GOOD.replace(",12,", ",1234567890123456789,"), GOOD.replace(",12,", ", 12,"), GOOD.replace("02-29", "02-30"), GOOD.replace("10:00:00", "24:00:00"), GOOD.replace("Z", ""), GOOD + "\n", GOOD.replace("2020", "0000"), GOOD.replace(",12,", ",１２,")]
    got = statuses(spark, bad)
    assert [got[i]["status"] for i in range(len(bad))] == ["rejected"] * len(bad)
    assert all(got[i]["reason"] for i in got)
    assert got[0]["reason"] == "null text" and "insert delimiter" in got[1]["reason"] and "delete delimiter" in got[3]["reason"]
    assert got[3]["cost"] == 1 and got[5]["cost"] >= 1


def test_long_and_clashing(spark):
    df = spark.createDataFrame([("f", 1, GOOD.replace("bob", "x" * 300_000), "mine", "theirs")], "source_file string, line_number int, raw_text string, url string, Status string")
    r = parse_records(df).first()
    assert r["status"] == "loaded" and len(r["username"]) == 300_000 and r["url_in"] == "mine" and r["Status_in"] == "theirs"
    long = '",' * 2_000
    assert statuses(spark, [long])[0]["status"] == "rejected"


def test_empty_table(spark):
    df = spark.createDataFrame([], "source_file string, line_number int, raw_text string")
    assert parse_records(df).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='ab,"\n', max_size=6), min_size=7, max_size=7))
def test_round_trip(fields):
    text = ",".join('"' + f.replace('"', '""') + '"' for f in fields)
    assert cheapest(shape_of(text))[0] == 0
    assert _split(text) == fields
