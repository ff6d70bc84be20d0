"""Facts about search, de-duplication, watch lists, parsing, grouping, files, sinks and streams."""

import datetime as dt
import hashlib
import hmac
import random
import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.operators import dedup, grouping, records, search, watch
from siltstone.operators.stats import preferred_estimate
from siltstone.plans.pipeline import STAGES, report, run_pipeline
from siltstone.plans.registry import Tables
from siltstone.sources import files, sinks
from siltstone.sources.tables import row_statistics
from siltstone.streaming import feeds

T = dt.datetime


def col1(df):
    return sorted(r[0] for r in df.collect())


def test_query_language():
    assert search.parse_query('alpha domain:x.test "two words" other:y since:7d') == (["alpha", "two words", "other:y"], {"domain": ["x.test"], "since": ["7d"]})
    assert search.parse_query('broken "quote')[0] == ["broken", '"quote']
    assert search.since_bound("soon", "2017-01-01") is None


def test_filter_before_limit(spark):
    df = spark.createDataFrame([(1, "a.test", "u", "elm"), (2, "a.test", "u", "oak")], "id long, domain string, username string, stealer_type string").withColumn("email_domain", F.lit(None).cast("string"))
    assert col1(df.filter(search.predicate("a.test stealer:elm")).orderBy(F.desc("id")).limit(1).select("id")) == [1]


def test_soft_identity(spark):
    df = spark.createDataFrame([(1, "s", "h1"), (2, "s", "h2"), (3, None, "h3"), (4, None, None)], "id long, soft_credential_hash string, credential_hash string")
    assert df.agg(F.count_distinct(search.identity())).first()[0] == 3
    assert col1(search.keep_first(df, search.identity(), F.col("id")).select("id")) == [1, 3, 4]


def test_invalid_regex_filters_nothing(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert df.filter(search.matches_any("(", ["x"])).count() == 1


def test_contains_many_equals_theta(spark, monkeypatch):
    texts = ["alpha beta", "ALPHABET", "gamma", None, "beta", "", "Ba", "é-Élan"]
    words = {1: "alpha", 2: "bet", 3: "zzz", 4: "b", 5: "BA", 6: "", 7: None, 8: "É"}
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    needles = spark.createDataFrame(list(words.items()), "n long, q string")
    want = sorted((i, n) for i, t in enumerate(texts) for n, q in words.items() if t and q and q.lower() in t.lower())
    assert sorted(map(tuple, search.contains_many(rows, ["id"], "t", needles, "n", "q").collect())) == want
    assert search.contains_many(rows, ["id"], "t", needles.filter("q = ''"), "n", "q").count() == 0
    monkeypatch.setattr(search, "NEEDLE_CHARS", 3)
    assert sorted(map(tuple, search.contains_many(rows, ["id"], "t", needles, "n", "q").collect())) == want


def test_watch_plan_has_no_nested_loop(spark):
    items = spark.createDataFrame([(1, "a", "any"), (2, "shop", "domain")], "item_id long, query string, match_type string")
    records = spark.createDataFrame([(1, "shop.test", "u", "x", "y")], "id long, domain string, username string, url string, email_domain string")
    plan = watch.hits(items, records)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_over_ranges_equals_brute_force(spark):
    """A hot group over many ranges, small groups, gaps and repeated rows."""
    rng = random.Random(4)
    rows = [(7, x) for x in rng.sample(range(3000), 400)] + [(g, rng.randrange(60)) for g in range(6) for _ in range(g)] + [(7, None), (None, 3), (8, 5)]
    df = spark.createDataFrame(rows + rows[:20], "g long, p long")
    want = set()
    for g in {g for g, _ in rows if g is not None}:
        ps = sorted({p for x, p in rows if x == g and p is not None})
        for p in ps:
            want |= {(g, p, q, abs(p - q)) for q in sorted((q for q in ps if q != p), key=lambda q: (abs(q - p), q))[:4]}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = [tuple(r) for r in dedup.nearest(df, "g", "p", 2).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == len(set(got)) and set(got) == want


def test_early_skips(spark):
    rows = [("l", b, *x) for b, x in enumerate([(1, 19), (9, 11), (0, 20), (1, 19), (0, 20), (15, 5), (0, 20)])] + [("m", 0, 0, 20), ("m", 1, 0, 20)]
    df = spark.createDataFrame(rows, "load string, batch int, new long, dup long")
    got = dedup.early_skips(df, "load", "batch", F.lit(20), 0.95, 3).orderBy("load", "batch").collect()
    assert [r["full"] for r in got] == [True, False, True, True, True, False, True, True, True]
    assert [r["skipped"] for r in got] == [False] * 5 + [True, True] + [False, False]


def test_loads_count_rows_against_all_before(spark):
    rows = [(1, "a", 1, "x"), (2, "a", 1, "x"), (3, "a", 2, "y"), (4, "b", 1, "x"), (5, "b", 1, None)]
    df = spark.createDataFrame(rows, "id long, load string, batch int, k string")
    got = {(r["load"], r["batch"]): (r["n"], r["new"], r["dup"]) for r in dedup.load_accounting(df, "k", "load", "batch", "id").collect()}
    assert got == {("a", 1): (2, 1, 1), ("a", 2): (1, 1, 0), ("b", 1): (2, 1, 1)}


def test_only_missing_values_are_filled(spark):
    known = spark.createDataFrame([(1, "a", None), (2, None, None), (3, None, "t")], "k long, name string, title string")
    found = spark.createDataFrame([(1, "z", "T", 5), (2, None, "no", 1), (2, "n1", None, 2), (2, "n2", "later", 3), (None, "q", "q", 1)], "k long, name string, title string, o long")
    got = {r["k"]: (r["name"], r["title"]) for r in dedup.fill_missing(known, found, "k", ["name", "title"], "o").collect()}
    assert got == {1: ("a", "T"), 2: ("n1", "no"), 3: (None, "t")}


def test_estimates(spark):
    df = spark.createDataFrame([(168_815_328, 5), (-1, None), (None, None), (3, 9)], "a long, b long")
    assert [r[0] for r in df.select(preferred_estimate(F.col("a"), F.col("b"))).collect()] == [168_815_328, 0, 0, 9]


def test_row_statistics_use_the_catalog(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "analysed_t.parquet"))
    spark.read.parquet(str(tmp_path / "analysed_t.parquet")).write.saveAsTable("analysed_t", path=str(tmp_path / "copy"))
    spark.sql("ANALYZE TABLE analysed_t COMPUTE STATISTICS")
    try:
        assert tuple(row_statistics(spark, str(tmp_path), "analysed_t").first()) == ("analysed_t", 7, 7)
    finally:
        spark.sql("DROP TABLE analysed_t")


def test_saved_searches(spark):
    held = search.SavedSearches(spark)
    assert held.all().count() == 0
    df = spark.createDataFrame([(1, "a.test"), (2, "b.test")], "id long, domain string").withColumns({"username": F.lit(""), "email_domain": F.lit("")})
    assert held.run(df).count() == 0
    held.save("one", "a.test")
    held.save("two", "zzz")
    held.save("two", ".test")
    held.save("three", "b.test")
    held.remove("three")
    assert [tuple(r) for r in search.SavedSearches(spark, held.root).all().collect()] == [("one", "a.test"), ("two", ".test")]
    assert sorted((r["name"], r["id"]) for r in held.run(df).collect()) == [("one", 1), ("two", 1), ("two", 2)]


def test_record_export(spark):
    rows = [(i, f"shop{i}.test" if i % 2 else "x.shop.test", "u", None, f"https://h/{'login' if i % 3 else 'x'}", T(2020, 1, 1 + i), "s") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, domain string, username string, email_domain string, url string, created_at timestamp, password string")
    got = [r["line"] for r in sinks.export_records(df, "shop*", "LOGIN", ("url",), ["id"], limit=2).collect()]
    assert got == ['"7"', '"5"']
    with pytest.raises(ValueError):
        sinks.export_records(df, "shop", "(", ("url",), ["id", "password"])


def test_three_in_two_out(spark):
    staged = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, k string")
    assert dedup.new_rows(staged, staged.limit(0), "k", F.col("id")).count() == 2
    assert dedup.new_rows(staged, staged.filter("k = 'a'"), "k", F.col("id")).count() == 1


@pytest.mark.parametrize("new,dup,size,want", [(500, 19_500, 20_000, True), (1_200, 18_800, 20_000, False), (0, 9_000, 20_000, False)])
def test_duplicate_batch(spark, new, dup, size, want):
    assert spark.range(1).select(dedup.is_dup_batch(F.lit(new), F.lit(dup), F.lit(size))).first()[0] is want


def test_first_seen(spark):
    df = spark.createDataFrame([(1, "a", T(2020, 1, 2), 5), (2, "a", T(2020, 1, 1), 6), (3, "b", T(2020, 1, 1), 7)], "id long, c string, at timestamp, place long")
    got = {r["h"]: (r["place"], r["duplicates"]) for r in dedup.first_seen(df, F.col("c"), "at", ["place"], "id").collect()}
    assert got == {"a": (6, 1), "b": (7, 0)}


def test_watch_incremental(spark):
    items = spark.createDataFrame([(1, "shop", "domain", 1, 2, T(2020, 1, 1)), (2, "shop", "any", 0, 0, None)], "item_id long, query string, match_type string, last_count long, new_count long, last_checked_at timestamp")
    recs = spark.createDataFrame([(1, "shop.test", T(2019, 1, 1)), (2, "shop.test", T(2020, 1, 1)), (3, "shop.test", T(2021, 1, 1))], "id long, domain string, created_at timestamp")
    for c in ("username", "url", "email_domain"):
        recs = recs.withColumn(c, F.lit(None).cast("string"))
    r = watch.sweep_since(items, recs, F.col("id")).collect()
    assert [(x["item_id"], x["total"], x["new"]) for x in r] == [(1, 2, 3)]
    assert {x["item_id"]: x["total"] for x in watch.sweep(items, recs, F.col("id")).collect()} == {1: 3, 2: 3}


def test_hits_equal_brute_force(spark):
    recs = spark.createDataFrame([(i, d, u, f"https://{d}/x", None) for i, (d, u) in enumerate([("shop.test", "Ann"), ("hub.test", "bob"), (None, None), ("abc.test", "a1")])], "id long, domain string, username string, url string, email_domain string")
    items = spark.createDataFrame([(1, "SHOP", "domain"), (2, "a", "user"), (3, "test", "any"), (4, "b.te", "url"), (5, "zz", "odd")], "item_id long, query string, match_type string")
    kinds = {**watch.BY_TYPE, "odd": watch.BY_TYPE["any"]}
    want = sorted((i["item_id"], r["id"]) for i in items.collect() for r in recs.collect() if any(i["query"].lower() in (r[c] or "").lower() for c in kinds[i["match_type"]]))
    assert sorted((r["item_id"], r["id"]) for r in watch.hits(items, recs).collect()) == want and len(want) > 5


def test_release_removes_tables(spark, monkeypatch):
    from siltstone import session

    monkeypatch.setattr(session, "_written", [])
    df = session.materialise(spark.range(3), "released")
    path = session._written[0][1]
    assert df.count() == 3
    session.release(spark)
    fs, p = session.hadoop_path(spark, path)
    assert not fs.exists(p) and not session._written


def test_split_names(spark):
    names = ["a.part1.rar", "a.r00", "b_2of3.zip", "c.rar", "d.7z.001", "e.zip.002", "f.z01", "g.001", "h-vol2.zip", "i.txt", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r) for r in df.select(text.split_base(F.col("n")), text.split_part_number(F.col("n")), text.split_total(F.col("n"))).collect()]
    assert got[:3] == [("a", 1, None), ("a", 0, None), ("b", 2, 3)] and got[3] == ("c", None, None) and got[8] == ("h", 2, None) and got[9:] == [(None, None, None)] * 2


def test_grouping(spark):
    rows = [(1, 9, 1, "set.part1.rar"), (2, 9, 2, "set.part2.rar"), (3, 9, 3, "set.rar"), (4, 9, 4, "sеt.part3.rar"), (5, 8, 5, "set.part1.rar")]
    df = spark.createDataFrame(rows, "id long, conversation_id long, message_id long, filename string")
    got = {r["group"]: (r["n"], r["expected"], r["gap"]) for r in grouping.group_parts(df).collect()}
    assert got == {"set:9:set": (3, 3, False), "single:3": (1, 1, False), "set:8:set": (1, 1, False)}


def test_masks_and_keys(spark):
    df = spark.createDataFrame([("secret",), ("ab",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(text.masked(F.col("x"))).collect()] == ["s••••t (6 chars)", "••", "—", "—"]
    k = spark.createDataFrame([("Ａ_b-C",), ("а.Ь",)], "x string")
    assert k.select(text.group_key(F.col("x"))).first()[0] == "a b c"


def _records(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    return records.parse_texts(df, "k", "t").orderBy("k", "record_no").collect()


def _digest(secret, key=b"a test's key"):
    return hmac.new(key, secret.encode(), hashlib.sha256).hexdigest()


@pytest.fixture
def digest_key(spark):
    spark.conf.set("siltstone.digest.key", "a test's key")
    yield
    spark.conf.unset("siltstone.digest.key")


def test_line_parser_mixes_forms(spark, digest_key):
    src = "https://a.test/x:bob:p:w\n\nURL: https://b.test\nUser:\nann\nPassword: s\n---\n[App=P1]\nHost=https://c.test\nLogin=cy\nPass=t|u\n===\nhttps://d.test|dan|x|y\nhttps://e.test;eve;z\nURL: ftp://no\nPassword: q\n"
    want = [("https://a.test/x", "bob", None, None, "p:w"), ("https://b.test", "ann", None, None, "s"), ("https://c.test", "cy", "App", "P1", "t|u"), ("https://d.test", "dan", None, None, "x|y"), ("https://e.test", "eve", None, None, "z")]
    for k, rows in enumerate([_records(spark, [src.replace("\n", end)]) for end in ("\n", "\r\n", "\r")]):
        assert [(r["url"], r["username"], r["application"], r["profile"], r["digest"]) for r in rows] == [(*w[:4], _digest(w[4])) for w in want], k
        assert [r["record_no"] for r in rows] == [0, 1, 2, 3, 4]


def test_record_blocks(spark, digest_key):
    assert [(r["url"], r["username"]) for r in _records(spark, ["https://a.test | ann lee | w o\n  https://b.test/p ; bo ; x"])] == [("https://a.test", "ann lee"), ("https://b.test/p", "bo")]
    last, comment, none = _records(spark, ["url: https://a.test\nurl: https://b.test\npwd: 1", "URL: https://a.test\nPassword:\n# no value\nPass: 2\nBrowser: B", "URL: https://a.test\nPass: 3\nunlabelled line"])
    assert last["url"] == "https://b.test" and (comment["application"], comment["digest"]) == ("B", _digest("2")) and none["username"] == ""
    assert _records(spark, [None, "", "\n\n---\n", "URL: https://a.test\nUser: u", "Password: p", "just words " * 3000]) == []
    assert len(_records(spark, ["\n".join(f"https://h{i}.test:8080/a:u:p" for i in range(5000))])) == 5000


def test_chunks_lose_nothing(spark, digest_key):
    src = "\n".join(f"URL: https://h{i}.test\nPassword: p{i}\n" for i in range(40))
    df = spark.createDataFrame([(1, src)], "k long, t string")
    chunks = [c["chunk"] for c in files.line_chunks(df, "k", "t", 10).orderBy("chunk_no").collect()]
    assert len(chunks) > 5
    whole, parts = _records(spark, [src]), _records(spark, chunks)
    assert [(r["url"], r["digest"]) for r in parts] == [(r["url"], r["digest"]) for r in whole] and len(whole) == 40
    solid = spark.createDataFrame([(1, "\n".join("x" * 3 for _ in range(150)))], "k long, t string")
    assert sum(len(c["chunk"].splitlines()) for c in files.line_chunks(solid, "k", "t", 10).collect()) == 150


def test_digest_without_a_setting_is_the_sessions_own(spark):
    a, b = (_records(spark, ["https://a.test:u:p"])[0]["digest"] for _ in range(2))
    assert a == b != _digest("p") and a != hashlib.sha256(b"p").hexdigest()


def test_files_and_encodings(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes("größe".encode())
    (tmp_path / "b.txt").write_bytes("größe".encode("latin-1"))
    (tmp_path / "sub/c.txt").write_bytes("größe".encode("utf-16"))
    (tmp_path / "d.txt").write_bytes(b"ab\0\0\0cd")
    (tmp_path / "e.txt").write_bytes("größe".encode("utf-16-le"))
    (tmp_path / "f.txt").write_bytes("größe".encode("utf-16-be"))
    (tmp_path / "g.txt").write_bytes("größe".encode("utf-8-sig"))
    for n in ("x.part1.rar", "x.part2.rar", "y.zip", "z.7z.002"):
        (tmp_path / n).write_bytes(b"-")
    assert [r["text"] for r in files.read_texts(spark, str(tmp_path)).collect()] == ["größe"] * 6
    (tmp_path / "sub/w.txt").write_bytes("„größe“ € 5".encode("cp1252"))
    assert [r["text"] for r in files.read_texts(spark, str(tmp_path), "w.txt").collect()] == ["„größe“ € 5"]
    names = [r["path"].rsplit("/", 1)[1] for r in files.first_parts(files.list_files(spark, str(tmp_path))).collect()]
    assert sorted(n for n in names if not n.endswith("txt")) == ["x.part1.rar", "y.zip"]


def test_folder_is_loaded_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("https://a.test:u:p\nhttps://a.test:u:p\n\nURL: https://b.test\nPass: x\n")
    (tmp_path / "in/b.txt").write_text("https://a.test:u:p\nhttps://c.test|v|q\n")
    (tmp_path / "in/c.txt").write_bytes(b"\0\0\0\0")
    load = lambda: files.load_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert (load(), load()) == (3, 0)
    (tmp_path / "in/d.txt").write_text("https://d.test;w;r\n")
    assert load() == 1 and "secret" not in spark.read.parquet(str(tmp_path / "out")).columns


def test_adverts_are_cut(spark):
    values = ["bob ┃ t.me/shop now", "bob | https://t.me/x", "bob you can buy more", "bob dm @x", "bob [to buy dm me]", " bob\0", "buyer", "[tag] bob", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [tuple(r) for r in df.select(text.cleaned(F.col("x"), name=True), text.cleaned(F.col("x"))).collect()]
    assert [g[0] for g in got] == ["bob"] * 6 + ["buyer", "[tag] bob", None]
    assert got[4][1] == "bob [" and got[7][1] == "[tag] bob"


def test_rates_and_links(spark):
    df = spark.createDataFrame([(12_345.0, 10.0), (1.0, 0.0), (None, 1.0)], "n double, s double")
    assert [r[0] for r in df.select(text.rate(F.col("n"), F.col("s"))).collect()] == ["1,234/s", "—", "—"]
    t = spark.createDataFrame([("see T.me/Some_Name and https://telegram.me/+Ab-1 and @other_one x@mailhost @gmail",)], "x string")
    assert [sorted(x) for x in t.select(text.linked_names(F.col("x")), text.invitations(F.col("x")), text.mentions(F.col("x"))).first()] == [["some_name"], ["Ab-1"], ["other_one"]]


def _plain(t):
    """Markdown marks taken off by an independent reading with Python's expressions."""
    t = re.sub(r"!?\[([^\]]+)\]\([^)]+\)", r"\1", t)
    t = re.sub(r"`([^`]+)`", r"\1", t)
    for c in "*_":
        t = re.sub(rf"[{c}][{c}]([^{c}]+)[{c}][{c}]", r"\1", t)
    for c in "*_":
        out, at = [], 0
        while at < len(t):
            if t[at] == c and t[at - 1 : at] != c and at + 1 < len(t):
                end = t.find(c, at + 1)
                if end > at + 1 and t[end + 1 : end + 2] != c:
                    out.append(t[at + 1 : end])
                    at = end + 1
                    continue
            out.append(t[at])
            at += 1
        t = "".join(out)
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = t.replace(a, b)
    return t


def test_markdown_of_every_text(spark, small):
    from siltstone.plans.function_queries import registry

    more = ["**a** *b* __c__ _d_ `e` [f](g) ![h](i)", "a**b*c*", "*a*b*c*d*", "snake_case_name", "*x **y* z**", "&amp;lt;", "***t***", "_ _", "**", ""]
    marked = spark.createDataFrame([(x,) for x in more], "x string")
    assert [r[0] for r in marked.select(text.without_markdown(F.col("x"))).collect()] == [_plain(x) for x in more]
    texts = {r["doc_id"]: r["text"] for r in Tables(spark, small).documents.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["plain"] for r in registry.queries()["strip_markdown"](spark, small).collect()}
    assert got == {k: t if t is None else _plain(t) for k, t in texts.items()}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a"b', None, "s"), (2, "p|q\nr", "z", "t")], "id long, x string, y string, password string")
    assert col1(sinks.csv_lines(df)) == ['"1","a""b",""', '"2","p|q\nr","z"']
    assert col1(sinks.markdown_lines(df))[1] == "| 2 | p\\|q<br>r | z |"
    assert '"y":null' in sinks.to_json(df).first()[0] and "password" not in sinks.to_json(df).first()[0]
    sinks.to_csv(df, str(tmp_path / "csv"))
    assert "password" not in spark.read.csv(str(tmp_path / "csv"), header=True).columns
    assert sinks.markdown_table("t", ["a"], []) == "## t\n\nNo rows matched.\n"
    at = str(tmp_path / "target")
    assert sinks.append_new(df, at, "id", F.col("id")) == 2
    assert sinks.append_new(df, at, "id", F.col("id")) == 0


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    feed, mark = tmp_path / "feed", tmp_path / "mark"
    rows = [(f"k{i % 3}", T(2020, 1, 1 + (7 * i) % 9), i) for i in range(12)]
    ddl = "k string, at timestamp, place long"
    out = feeds.LatestTable(spark, "k", "duplicates")

    def consume():
        s = feeds.first_seen(feeds.file_stream(spark, str(feed), spark.createDataFrame([], ddl).schema), "k", "at", "place")
        feeds.run(s, out.write, "t", "update", str(mark))

    spark.createDataFrame(rows[:6], ddl).coalesce(1).write.parquet(str(feed))
    consume()
    spark.createDataFrame(rows[6:], ddl).coalesce(1).write.mode("append").parquet(str(feed))
    consume()
    got = {r["k"]: (r["place"], r["duplicates"]) for r in out.read().collect()}
    want = {r["h"]: (r["place"], r["duplicates"]) for r in dedup.first_seen(spark.createDataFrame(rows, ddl), F.col("k"), "at", ["place"], "place").collect()}
    assert got == want


def test_another_instance_goes_on_with_the_table(spark):
    ddl = "k long, v string, duplicates long"
    first = feeds.LatestTable(spark, "k", "duplicates", fold_after=3)
    first.write(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], ddl), 0)
    first.write(spark.createDataFrame([(2, "c", 1)], ddl), 1)
    again = feeds.LatestTable(spark, "k", "duplicates", first.root, fold_after=3)
    again.write(spark.createDataFrame([(3, "d", 0)], ddl), 2)
    assert again._folders() == (2, [])
    again.write(spark.createDataFrame([(3, "d", 0)], ddl), 2)  # a repeated batch changes nothing
    again.write(spark.createDataFrame([(1, "e", 5)], ddl), 3)
    last = feeds.LatestTable(spark, "k", "duplicates", first.root)
    assert sorted((r["k"], r["v"]) for r in last.read().collect()) == [(1, "e"), (2, "c"), (3, "d")]


def test_marks_move_after_success(spark):
    rows = spark.createDataFrame([(1, "@first"), (2, "@second")], "id long, text string")
    marks, seen = feeds.Marks(spark), []
    take = lambda fresh: seen.append(col1(fresh.select("id")))

    def fails(fresh):
        raise ValueError

    with pytest.raises(ValueError):
        marks.scan(rows, "m", "id", fails)
    assert marks.get("m") is None
    assert marks.scan(rows, "m", "id", take) == 2
    # the second scan omits what the first saw, in another session as well
    again = feeds.Marks(spark, marks.state.root)
    assert again.scan(rows, "m", "id", take) == 2
    assert again.scan(rows.union(rows.select(F.lit(3).cast("long"), "text").limit(1)), "m", "id", take) == 3
    again.scan(rows, "other", "id", take)
    assert seen == [[1, 2], [3], [1, 2]] and again.get("m") == 3


ITEM = "item_id long, query string, match_type string, last_count long, new_count long, last_checked_at timestamp"
RECORD = "id long, domain string, username string, url string, email_domain string, created_at timestamp, soft_credential_hash string, credential_hash string"


def _record(i, domain, day):
    return (i, domain, "u", None, None, T(2020, 1, day), None, None)


def test_watch_counts_of_a_stream(spark):
    """Three records, one after the mark: new goes from 2 to 3, known from 1 to 2; a repeated batch changes nothing."""
    items = spark.createDataFrame([(1, "shop", "domain", 1, 2, T(2020, 1, 5)), (2, "shop", "domain", 7, 7, None)], ITEM)
    batch = spark.createDataFrame([_record(1, "shop.test", 1), _record(2, "other.test", 9), _record(3, "shop.test", 8)], RECORD)
    counts = feeds.WatchCounts(items, search.identity())
    for n in (0, 0):
        counts.write(batch, n)
    assert {r["item_id"]: (r["total"], r["new"]) for r in counts.counts().collect()} == {1: (2, 3), 2: (7, 7)}
    counts.write(spark.createDataFrame([_record(4, "myshop.test", 9)], RECORD), 1)
    again = feeds.WatchCounts(items, search.identity(), root=counts.state.root)
    assert {r["item_id"]: (r["total"], r["new"], r["mark"]) for r in again.counts().collect()} == {1: (3, 4, T(2020, 1, 9)), 2: (7, 7, None)}


def test_alerts_seed_then_tell(spark):
    """One record before and one after the mark: the first run is silent, the second tells of one, the total is 2."""
    items = spark.createDataFrame([(1, "shop", "any", 0, 0, None)], ITEM)
    records = spark.createDataFrame([_record(1, "shop.test", 1), _record(2, "shop.test", 8)], RECORD)
    alerts = watch.Alerts(spark)
    assert alerts.run(items, records.filter("id = 1"), search.identity(), "2020-01-05 00:00:00").count() == 0
    again = watch.Alerts(spark, alerts.state.root)
    assert [tuple(r) for r in again.run(items, records, search.identity(), "2020-01-10 00:00:00").collect()] == [(1, 1, 2, 1)]
    assert again.run(items, records, search.identity(), "2020-01-11 00:00:00").count() == 0
    assert watch.sweep(items, records, search.identity()).first()["total"] == 2 and again.marks().first()["told"] == 1


def test_restart_states(spark):
    from siltstone.plans.search_queries import restart_states

    rows = [("F", 1, T(2020, 1, 1)), ("F", 9, T(2020, 1, 1)), ("O", 1, T(2020, 1, 1)), ("O", 1, T(2020, 1, 9, 23)), ("P", 0, None), ("O", 1, None)]
    df = spark.createDataFrame(rows, "s string, n int, at timestamp")
    assert [r[0] for r in df.select(restart_states(F.col("s"), F.col("n"), F.col("at"), "2020-01-10 00:00:00", 3, 24)).collect()] == ["P", "F", "P", "O", "P", "O"]


def test_short_lists_are_sent_to_the_names(spark, small):
    from siltstone.plans.stats_queries import registry

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()["forwarding_matrix"](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_distinct_counts_do_not_expand(spark, small):
    from siltstone.plans.stats_queries import registry

    for name in ("distinct_totals", "archive_stats", "funnel"):
        assert "Expand" not in registry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()


def test_days_act_on_the_scan(spark, small):
    from siltstone.plans.stats_queries import registry

    plan = registry.queries()["top_by_messages"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(platform_timestamp" in plan[plan.index("PushedFilters") :]


def test_pipeline_tells_of_failures(spark, small):
    def late(t, run):
        return t.channels.select(F.raise_error(F.lit("no")).alias("x"))

    got = report(Tables(spark, small), run_pipeline(Tables(spark, small), {"late": late, "discover": STAGES["discover"]}))
    assert sorted((r["stage"], r["state"], r["rows"] is None) for r in got.collect()) == [("discover", "made", False), ("late", "failed", True)]


def test_pipeline_goes_on_after_a_failure(spark, small):
    def broken(t, run):
        raise ValueError("no")

    run = run_pipeline(Tables(spark, small), {"first": broken, "parse": STAGES["parse"]})
    assert run.failed == {"first": "no"} and run.made["parse"].count() > 0


def test_progress_and_notices(spark, tmp_path):
    log = feeds.ProgressLog()
    spark.streams.addListener(log)
    spark.createDataFrame([(1, "shop.test", "s3cret")], "id long, domain string, password string").coalesce(1).write.parquet(str(tmp_path / "in"))
    out = feeds.Appender(spark, "notices")
    s = feeds.notices(feeds.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema), ["domain"])
    feeds.run(s, out.write, "notices")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.streams.removeListener(log)
    assert out.read(s.schema).first().asDict() == {"id": 1, "domain": "s•••••••t (9 chars)"}
    assert log.table(spark).agg(F.sum("rows")).first()[0] == 1


def test_xlsx_is_gated(spark, tmp_path):
    import importlib.util

    df = spark.createDataFrame([(1, "x")], "id long, password string")
    assert sinks.to_xlsx({"a": df}, str(tmp_path / "a.xlsx")) is (importlib.util.find_spec("openpyxl") is not None)


def test_time_conditions_reach_the_files(spark, small):
    from siltstone.plans.search_queries import registry

    plan = registry.queries()["since_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan[plan.index("PushedFilters") :]


def test_keep_first_ci_takes_every_hostname(spark, tmp_path):
    from siltstone.plans.search_queries import registry

    names = ["Älpha", "äLPHA ", "\u00a0ÄLPHA", "ЁЖ-1", "ёж-1", "ΟΔΟΣ", "οδος", "İ", "Plain", "pLAIN\t", "東京", None]
    rows = list(enumerate(names))
    spark.createDataFrame(rows[::-1], "id long, hostname string").write.parquet(str(tmp_path / "system_info.parquet"))
    want = {}
    for i, name in rows:
        if name is not None:
            want.setdefault(name.strip().lower(), i)
    got = {r["k"]: r["id"] for r in registry.queries()["keep_first_ci"](spark, str(tmp_path)).collect()}
    assert got == want and len(want) == 6


def test_parse_sheet_takes_every_line_end(spark, tmp_path):
    from siltstone.plans.feed_queries import registry

    plain = "Machine: elm-1\nBuild: b7\n\nMachine = Élan 2\n---\nBuild: none\n"
    mixed = "Machine: elm-1\r\nBuild: b7\n\r\nMachine = Élan 2\r---\r\nBuild: none\r"
    docs = [(1, "system_sheet", plain), (2, "system_sheet", plain.replace("\n", "\r\n")), (3, "system_sheet", plain.replace("\n", "\r")), (4, "system_sheet", mixed), (5, "system_sheet", None), (6, "note", mixed)]
    spark.createDataFrame(docs, "doc_id long, doc_kind string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in registry.queries()["parse_sheet"](spark, str(tmp_path)).collect())
    want = [("elm-1", "b7"), ("Élan 2", None)]
    assert got == sorted(((i, *w) for i in (1, 2, 3, 4) for w in want), key=lambda r: (r[0], r[1]))


def test_first_seen_keeps_rows_without_time_or_place(spark, tmp_path):
    big = 2**60 + 1
    rows = [(1, "a", None, 5), (2, "a", T(2020, 1, 2), big), (3, "a", None, None), (4, "b", T(2020, 1, 1), None), (5, "b", T(2020, 1, 2), 8), (6, "c", None, 9), (7, "c", None, None), (8, "d", None, None), (9, None, T(2020, 1, 1), 1)]
    ddl = "id long, c string, at timestamp, place long"
    df = spark.createDataFrame(rows, ddl)
    want = {"a": (T(2020, 1, 2), big, 2), "b": (T(2020, 1, 1), None, 1), "c": (None, 9, 1), "d": (None, None, 0)}
    assert {r["h"]: (r["first"], r["place"], r["duplicates"]) for r in dedup.first_seen(df, F.col("c"), "at", ["place"], "id").collect()} == want

    for i in range(0, len(rows), 3):
        spark.createDataFrame(rows[i : i + 3], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    out = feeds.LatestTable(spark, "c", "duplicates")
    feeds.run(feeds.first_seen(feeds.file_stream(spark, str(tmp_path / "feed"), df.schema), "c", "at", "place"), out.write, "nulls", "update")
    got = out.read().withColumn("at", F.timestamp_micros("first_us")).collect()
    assert {r["c"]: (r["at"], r["place"], r["duplicates"]) for r in got} == want


def test_finalise_indexes_every_text(spark, tmp_path):
    docs = [(1, "x", None, 5), (2, "x", T(2020, 1, 1), None), (3, "y", None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, platform_timestamp timestamp, conversation_id long").write.parquet(str(tmp_path / "documents.parquet"))
    run = run_pipeline(Tables(spark, str(tmp_path)), {"finalise": STAGES["finalise"]})
    got = [(r["first"], r["conversation_id"], r["duplicates"]) for r in run.made["finalise"].collect()]
    assert sorted(got, key=str) == sorted([(T(2020, 1, 1), None, 1), (None, None, 0)], key=str)
