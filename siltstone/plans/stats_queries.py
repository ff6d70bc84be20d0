"""Top lists, series, funnels, rates and facets of the dashboard.

Channels, messages, attachments and records are the tables of those names; the
chain from an attachment through artifact and job, which no table holds, is
played by lineitem (attachment), part (artifact, present up to size 40 and
completed up to 30) and supplier (job, completed with a positive balance) below
customer (channel) and orders (message).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.search import without_sources
from siltstone.operators.stats import bursts, daily, hours_between, late_lookup, monthly_pivot, percent, preferred_estimate, since, top_n, top_per_group
from siltstone.plans.registry import Registry, Tables
from siltstone.sources.tables import row_statistics

registry = Registry()
query = registry.query
NOW, N = "2017-03-31 00:00:00", 20
TYPES = ("alder", "birch", "cedar", "dogwood", "elm")


def n_rows():
    return F.count(F.lit(1))


ONCE = "(SELECT conversation_id, platform_id, max(platform_timestamp) AS ts, bool_or(is_forwarded) AS fwd, max(forwarded_from_id) AS src FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL GROUP BY 1, 2)"


def once(t: Tables, days: int = 0, left_out: DataFrame | None = None) -> DataFrame:
    """One row for each message, whatever its number of deliveries.

    ``ts`` is the latest instant told, so messages of the last ``days`` days are
    those with a delivery that tells one: the condition acts on the scan, before
    anything is grouped.  Channels in ``left_out`` are dropped there as well.
    """
    m = since(t.messages, "platform_timestamp", NOW, days).filter("conversation_id is not null and platform_id is not null")
    if left_out is not None:
        m = without_sources(m, "conversation_id", left_out)
    return m.groupBy("conversation_id", "platform_id").agg(F.max("platform_timestamp").alias("ts"), F.bool_or("is_forwarded").alias("fwd"), F.max("forwarded_from_id").alias("src"))


def channel_messages(t: Tables, days: int = 0, left_out: DataFrame | None = None) -> DataFrame:
    return t.channels.select(F.col("platform_id").alias("conversation_id"), "title").join(once(t, days, left_out), "conversation_id")


#: Panels take a number of days (0 for all) and channels to leave out; each has queries of its own.
PANEL_DAYS = (0, 7, 30, 90)
LEFT_OUT = "SELECT platform_id FROM channels WHERE title ILIKE '%ledger%'"


def _left_out(t: Tables) -> DataFrame:
    return t.channels.filter(F.col("title").ilike("%ledger%")).select("platform_id")


def once_sql(days: int, filtered: bool) -> str:
    more = (f" AND platform_timestamp >= TIMESTAMP '{NOW}' - INTERVAL {days} DAY" if days else "") + (f" AND conversation_id NOT IN ({LEFT_OUT})" if filtered else "")
    return ONCE.replace(" GROUP BY", more + " GROUP BY")


def panel(sql: str, default: int = 0):
    """Registers a panel under its name with ``default`` days, with each other number of days, and with channels left out."""

    def add(f):
        for days, filtered in [(default, True), *[(d, False) for d in PANEL_DAYS]]:
            name = f.__name__ + ("_some" if filtered else f"_{days}d" if days != default else "")
            query(sql.replace("$ONCE", once_sql(days, filtered)), name)(lambda t, days=days, filtered=filtered: f(t, days, _left_out(t) if filtered else None))
        return f

    return add


TOP = f"SELECT c.platform_id AS conversation_id, c.title, {{0}} AS n FROM channels c JOIN $ONCE m ON m.conversation_id = c.platform_id {{1}} GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT {N}"


@panel(TOP.format("count(*)", ""), 30)
def top_by_messages(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    n = once(t, days, left_out).groupBy("conversation_id").agg(n_rows().alias("n"))
    return t.channels.select(F.col("platform_id").alias("conversation_id"), "title").join(n, "conversation_id").orderBy(F.desc("n"), "conversation_id", "title").limit(N)


def attached(t: Tables) -> DataFrame:
    a = t.file_attachments.select("conversation_id", F.col("message_id").alias("platform_id"), "filename", "mime_type", "size")
    return channel_messages(t).join(a, ["conversation_id", "platform_id"])


ATTACHED = f"channels c JOIN {ONCE} m ON m.conversation_id = c.platform_id JOIN file_attachments a ON a.conversation_id = m.conversation_id AND a.message_id = m.platform_id"


@query(f"SELECT c.platform_id AS conversation_id, c.title, count(*) AS n FROM {ATTACHED} GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT {N}")
def top_by_attachments(t: Tables) -> DataFrame:
    return top_n(attached(t), ["conversation_id", "title"], n_rows(), N)


@query(f"SELECT c.platform_id AS conversation_id, c.title, count(*) AS n FROM {ATTACHED} WHERE regexp_matches(lower(a.filename), '\\.(zip|rar|7z)$') GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT {N}")
def top_by_archives(t: Tables) -> DataFrame:
    return top_n(attached(t).filter(F.lower("filename").rlike(r"\.(zip|rar|7z)$")), ["conversation_id", "title"], n_rows(), N)


@query(f"SELECT c.platform_id AS conversation_id, c.title, count(*) AS n FROM channels c JOIN parsed_credentials p ON p.source_conversation_id = c.platform_id GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT {N}")
def top_by_records(t: Tables) -> DataFrame:
    # counted before the join: one row a channel meets the dimension
    n = t.parsed_credentials.groupBy(F.col("source_conversation_id").alias("conversation_id")).agg(n_rows().alias("n"))
    c = t.channels.select(F.col("platform_id").alias("conversation_id"), "title")
    return c.join(n, "conversation_id").orderBy(F.desc("n"), "conversation_id", "title").limit(N)


@panel(f"SELECT * FROM (SELECT src AS forwarded_from_id, count(*) AS n FROM $ONCE m WHERE fwd GROUP BY 1 ORDER BY n DESC, 1 NULLS FIRST LIMIT {N}) WHERE forwarded_from_id IS NOT NULL")
def forwarded_sources(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    """The limit comes before nulls are dropped, so one row fewer may come out."""
    top = once(t, days, left_out).filter("fwd").groupBy(F.col("src").alias("forwarded_from_id")).agg(n_rows().alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("forwarded_from_id")).limit(N)
    return top.filter("forwarded_from_id is not null")


@panel(TOP.format("count(*)", "WHERE fwd"))
def forwarding_channels(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    return top_n(channel_messages(t, days, left_out).filter("fwd"), ["conversation_id", "title"], n_rows(), N)


@panel(TOP.format("count(DISTINCT src)", "WHERE fwd"))
def diverse_sources(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    return top_n(channel_messages(t, days, left_out).filter("fwd"), ["conversation_id", "title"], F.count_distinct("src"), N)


@panel(f"SELECT c.platform_id AS conversation_id, c.title, count(*) AS n FROM $ONCE m JOIN channels c ON m.src = c.platform_id GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT {N}")
def amplified_sources(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    c = t.channels.select(F.col("platform_id").alias("src"), "title")
    return top_n(once(t, days, left_out).drop("conversation_id").join(c, "src").withColumnRenamed("src", "conversation_id"), ["conversation_id", "title"], n_rows(), N)


DAILY = "WITH d AS (SELECT CAST({1} AS DATE) AS day, count(*) AS n FROM {0} WHERE {1} IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT {2}) SELECT day, n, CAST(floor(n * 100 / max(n) OVER ()) AS BIGINT) AS pct FROM d"


@panel(DAILY.format("$ONCE m", "ts", 30))
def daily_messages(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    """A message counts once, however often it was delivered."""
    return daily(once(t, days, left_out), "ts")


@query(DAILY.format("parsed_credentials", "created_at", 30))
def daily_records(t: Tables) -> DataFrame:
    return daily(t.parsed_credentials, "created_at")


@query("SELECT CAST(created_at AS DATE) AS day, count(*) AS n FROM parsed_credentials WHERE created_at >= TIMESTAMP '2017-03-17' GROUP BY 1")
def daily_14d(t: Tables) -> DataFrame:
    return since(t.parsed_credentials, "created_at", NOW, 14).groupBy(F.to_date("created_at").alias("day")).agg(n_rows().alias("n"))


@panel(f"""WITH x AS (SELECT conversation_id, src, count(*) AS n FROM $ONCE m WHERE fwd AND src IS NOT NULL GROUP BY ALL ORDER BY n DESC, 1, 2 LIMIT {N})
SELECT x.*, d.title AS to_title, s.title AS from_title FROM x LEFT JOIN channels d ON d.platform_id = x.conversation_id LEFT JOIN channels s ON s.platform_id = x.src""")
def forwarding_matrix(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    """Edges by count; names are looked up for the short list only."""
    top = top_n(once(t, days, left_out).filter("fwd and src is not null"), ["conversation_id", "src"], n_rows(), N)
    to, fr = t.channels.select(F.col("platform_id").alias("k1"), F.col("title").alias("to_title")), t.channels.select(F.col("platform_id").alias("k2"), F.col("title").alias("from_title"))
    named = late_lookup(top, to, F.col("k1") == F.col("conversation_id"))
    return late_lookup(named, fr, F.col("k2") == F.col("src")).select("conversation_id", "src", "n", "to_title", "from_title")


# -- the chain of artifacts and jobs ------------------------------------------
CHAIN = """customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
 LEFT JOIN (SELECT p_partkey, CASE WHEN p_size <= 30 THEN 'COMPLETED' ELSE 'FAILED' END AS a_status FROM part WHERE p_size <= 40) p ON p.p_partkey = l.l_partkey
 LEFT JOIN (SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 'COMPLETED' ELSE 'FAILED' END AS j_status FROM supplier WHERE s_acctbal < 8000) s ON s.s_suppkey = l.l_suppkey AND p.p_partkey IS NOT NULL"""


def chain(t: Tables) -> DataFrame:
    """Outer chain: every attachment, its artifact if there is one, and that one's job."""
    artifact = t.part.filter("p_size <= 40").select(F.col("p_partkey").alias("artifact"), F.when(F.col("p_size") <= 30, "COMPLETED").otherwise("FAILED").alias("a_status"))
    job = t.supplier.filter("s_acctbal < 8000").select(F.col("s_suppkey").alias("job"), F.when(F.col("s_acctbal") > 0, "COMPLETED").otherwise("FAILED").alias("j_status"))
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    base = t.customer.select("c_custkey", "c_name").join(o, F.col("o_custkey") == F.col("c_custkey")).join(l, F.col("l_orderkey") == F.col("o_orderkey"))
    with_artifact = base.join(artifact, F.col("artifact") == F.col("l_partkey"), "left")
    return with_artifact.join(job, (F.col("job") == F.col("l_suppkey")) & F.col("artifact").isNotNull(), "left")


ONE = "l_orderkey || ':' || l_linenumber"


def _attachments(t: Tables) -> DataFrame:
    """One row for each attachment of the chain, with what became of it: the fan-out ends here, so plain sums follow."""
    by = chain(t).groupBy("c_custkey", "c_name", "l_orderkey", "l_linenumber")
    return by.agg(F.bool_or(F.col("l_returnflag") == "R").alias("archive"), F.bool_or(F.col("a_status").eqNullSafe("COMPLETED")).alias("downloaded"), F.bool_or(F.col("j_status").eqNullSafe("COMPLETED")).alias("extracted"))


@query(f"""SELECT c_custkey, c_name, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN {ONE} END) AS archives,
 count(DISTINCT CASE WHEN a_status = 'COMPLETED' THEN {ONE} END) AS downloaded, count(DISTINCT CASE WHEN j_status = 'COMPLETED' THEN {ONE} END) AS extracted,
 CAST(CASE WHEN archives > 0 THEN floor(downloaded * 100 / archives) ELSE 0 END AS BIGINT) AS download_rate FROM {CHAIN} GROUP BY ALL ORDER BY archives DESC, c_custkey LIMIT {N}""")
def archive_stats(t: Tables) -> DataFrame:
    by = _attachments(t).groupBy("c_custkey", "c_name").agg(F.count_if("archive").alias("archives"), F.count_if("downloaded").alias("downloaded"), F.count_if("extracted").alias("extracted"))
    return by.withColumn("download_rate", percent(F.col("downloaded"), F.col("archives"))).orderBy(F.desc("archives"), "c_custkey").limit(N)


@query(f"""SELECT count(DISTINCT {ONE}) AS discovered, count(DISTINCT CASE WHEN a_status = 'COMPLETED' THEN {ONE} END) AS downloaded,
 count(DISTINCT CASE WHEN j_status = 'COMPLETED' THEN {ONE} END) AS extracted FROM {CHAIN}""")
def funnel(t: Tables) -> DataFrame:
    return _attachments(t).agg(n_rows().alias("discovered"), F.count_if("downloaded").alias("downloaded"), F.count_if("extracted").alias("extracted"))


@query("SELECT coalesce(a_status, 'NONE') AS state, count(*) AS n, sum(size) AS pages FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS size FROM lineitem) JOIN orders ON o_orderkey = l_orderkey LEFT JOIN (SELECT p_partkey, CASE WHEN p_size <= 30 THEN 'COMPLETED' ELSE 'FAILED' END AS a_status FROM part WHERE p_size <= 40) ON p_partkey = l_partkey GROUP BY 1")
def backlog(t: Tables) -> DataFrame:
    """Attachments by the state of their artifact, those without one included."""
    artifact = t.part.filter("p_size <= 40").select("p_partkey", F.when(F.col("p_size") <= 30, "COMPLETED").otherwise("FAILED").alias("a_status"))
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(t.orders.select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    by = l.join(artifact, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy(F.coalesce("a_status", F.lit("NONE")).alias("state"))
    return by.agg(n_rows().alias("n"), F.sum("l_quantity").alias("pages"))


FIRST = "(SELECT sha256(text) AS h, min(platform_timestamp) AS t0, arg_min(conversation_id, (platform_timestamp, doc_id)) AS c0, count(*) AS k FROM documents WHERE text <> '' AND platform_timestamp IS NOT NULL GROUP BY 1)"


def _reposts(t: Tables, kinds: tuple[str, ...]) -> DataFrame:
    """Documents whose content another channel showed first, per channel."""
    d = t.documents.filter("text <> '' and platform_timestamp is not null").select("doc_id", "conversation_id", "doc_kind", F.sha2("text", 256).alias("h"), "platform_timestamp")
    first = d.groupBy("h").agg(F.min_by("conversation_id", F.struct("platform_timestamp", "doc_id")).alias("c0"))
    mine = d.filter(F.col("doc_kind").isin(*kinds) & F.col("conversation_id").isNotNull()).join(first, "h")
    by = mine.groupBy("conversation_id").agg(n_rows().alias("total"), F.count(F.when(F.col("c0") != F.col("conversation_id"), 1)).alias("reposts"))
    return by.withColumn("rate", percent(F.col("reposts"), F.col("total"))).orderBy(F.desc("reposts"), "conversation_id").limit(N)


REPOST = "SELECT d.conversation_id, count(*) AS total, count(CASE WHEN c0 <> d.conversation_id THEN 1 END) AS reposts, CAST(floor(reposts * 100 / total) AS BIGINT) AS rate FROM documents d JOIN {0} f ON f.h = sha256(d.text) WHERE d.text <> '' AND d.platform_timestamp IS NOT NULL AND doc_kind IN ({1}) AND d.conversation_id IS NOT NULL GROUP BY 1 ORDER BY reposts DESC, 1 LIMIT {2}"


@query(REPOST.format(FIRST, "'message', 'caption'", N))
def repost_downloads(t: Tables) -> DataFrame:
    return _reposts(t, ("message", "caption"))


@query(REPOST.format(FIRST, "'job_log', 'system_sheet', 'archive_listing'", N))
def repost_outputs(t: Tables) -> DataFrame:
    return _reposts(t, ("job_log", "system_sheet", "archive_listing"))


@query(f"SELECT c_custkey, count(*) AS n FROM {CHAIN} WHERE a_status = 'FAILED' GROUP BY 1 ORDER BY n DESC, 1 LIMIT {N}")
def failed_downloads(t: Tables) -> DataFrame:
    return top_n(chain(t).filter("a_status = 'FAILED'"), ["c_custkey"], n_rows(), N)


@query(f"SELECT c_custkey, count(*) AS n FROM {CHAIN} WHERE j_status = 'FAILED' GROUP BY 1 ORDER BY n DESC, 1 LIMIT {N}")
def failed_jobs(t: Tables) -> DataFrame:
    """A job counts once for each part that led to it."""
    return top_n(chain(t).filter("j_status = 'FAILED'"), ["c_custkey"], n_rows(), N)


@query(f"SELECT c_custkey, count(DISTINCT s_suppkey) AS n FROM {CHAIN} WHERE j_status = 'FAILED' GROUP BY 1 ORDER BY n DESC, 1 LIMIT {N}")
def failed_jobs_distinct(t: Tables) -> DataFrame:
    return top_n(chain(t).filter("j_status = 'FAILED'"), ["c_custkey"], F.count_distinct("job"), N)


LATENCY = "SELECT c_custkey, round(avg((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9), 6) AS hours FROM {0} WHERE {1} GROUP BY 1 ORDER BY hours DESC, 1 LIMIT {2}"


def _latency(t: Tables, where: str) -> DataFrame:
    hours = F.round(F.avg(hours_between(F.col("l_shipdate"), F.col("o_orderdate"))), 6)
    return top_n(chain(t).filter(where), ["c_custkey"], hours, N, "hours")


@query(LATENCY.format(CHAIN, "a_status = 'COMPLETED'", N))
def latency_download(t: Tables) -> DataFrame:
    return _latency(t, "a_status = 'COMPLETED'")


@query(LATENCY.format(CHAIN, "j_status = 'COMPLETED'", N))
def latency_job(t: Tables) -> DataFrame:
    return _latency(t, "j_status = 'COMPLETED'")


# -- records -------------------------------------------------------------------
@query(f"SELECT domain, count(*) AS n FROM parsed_credentials WHERE domain IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT {N}")
def top_domains(t: Tables) -> DataFrame:
    return top_n(t.parsed_credentials.filter("domain is not null"), ["domain"], n_rows(), N)


@query("SELECT stealer_type, count(*) AS n FROM parsed_credentials WHERE stealer_type IS NOT NULL GROUP BY 1")
def top_types(t: Tables) -> DataFrame:
    return top_n(t.parsed_credentials.filter("stealer_type is not null"), ["stealer_type"], n_rows(), N)


@panel("""WITH d AS (SELECT conversation_id, CAST(ts AS DATE) AS day, count(*) AS n FROM $ONCE m WHERE ts IS NOT NULL GROUP BY ALL)
SELECT conversation_id, max(n) AS peak, round(avg(n), 2) AS mean, round(max(n) / avg(n), 2) AS ratio FROM d GROUP BY 1 HAVING max(n) >= 10 AND max(n) / avg(n) >= 1.2""")
def bursty(t: Tables, days: int, left_out: DataFrame | None) -> DataFrame:
    return bursts(once(t, days, left_out), "conversation_id", "ts", 1.2)


@query("SELECT upper(trim(country)) AS country, count(*) AS n FROM system_info WHERE country IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def top_countries(t: Tables) -> DataFrame:
    return top_n(t.system_info.filter("country is not null").withColumn("country", F.upper(F.trim("country"))), ["country"], n_rows(), N)


@query(f"SELECT platform_id, title, discovered_at FROM channels ORDER BY discovered_at DESC NULLS LAST, platform_id LIMIT {N}")
def recent_channels(t: Tables) -> DataFrame:
    return t.channels.select("platform_id", "title", "discovered_at").orderBy(F.desc_nulls_last("discovered_at"), "platform_id").limit(N)


COUNTED = ("channels", "messages", "file_attachments", "parsed_credentials", "system_info", "raw_lines", "documents", "benchmark_items", "events")


@query(" UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS n FROM {x}" for x in COUNTED))
def table_counts(t: Tables) -> DataFrame:
    out = None
    for name in COUNTED:
        one = getattr(t, name).agg(n_rows().alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT o_orderstatus AS status, count(*) AS n, max(o_orderdate) AS latest FROM orders GROUP BY 1")
def queue_by_status(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(n_rows().alias("n"), F.max("o_orderdate").alias("latest"))


@query("SELECT count(*) AS n, max(created_at) AS latest FROM parsed_credentials WHERE created_at >= (SELECT max(created_at) FROM parsed_credentials) - INTERVAL 10 MINUTE")
def last_10m(t: Tables) -> DataFrame:
    p = t.parsed_credentials.select("created_at")
    latest = t.parsed_credentials.agg(F.max("created_at")).scalar()
    return p.filter(F.col("created_at") >= latest - F.expr("interval 10 minutes")).agg(n_rows().alias("n"), F.max("created_at").alias("latest"))


@query(" UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS estimate FROM {x}" for x in COUNTED))
def count_estimate(t: Tables) -> DataFrame:
    """Rows of each table by its statistics: parquet footers, and the catalog's where a table was analysed."""
    parts = [row_statistics(t.spark, t.folder, name) for name in COUNTED]
    return reduce(DataFrame.unionByName, parts).select("table_name", preferred_estimate(F.col("counted"), F.col("analysed")).alias("estimate"))


@query("SELECT extraction_job_id, count(*) AS n FROM parsed_credentials WHERE extraction_job_id IS NOT NULL GROUP BY 1")
def records_per_group(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter("extraction_job_id is not null").groupBy("extraction_job_id").agg(n_rows().alias("n"))


IDENTITY = "coalesce(soft_credential_hash, credential_hash, CAST(id AS VARCHAR))"


def identity() -> Column:
    return F.coalesce("soft_credential_hash", "credential_hash", F.col("id").cast("string"))


@query(f"WITH m AS (SELECT DISTINCT {IDENTITY} AS i FROM parsed_credentials WHERE domain ILIKE '%shop%') SELECT least(count(*), 10001) AS n, CASE WHEN count(*) > 10000 THEN '10,000+' ELSE CAST(count(*) AS VARCHAR) END AS shown FROM m")
def match_count_capped(t: Tables) -> DataFrame:
    """Distinct matches; what is shown stops at 10,000, what is counted does not."""
    n = t.parsed_credentials.filter(F.col("domain").ilike("%shop%")).agg(F.count_distinct(identity()).alias("k"))
    return n.select(F.least("k", F.lit(10001)).cast("long").alias("n"), F.when(F.col("k") > 10000, "10,000+").otherwise(F.col("k").cast("string")).alias("shown"))


@query(f"SELECT count(DISTINCT {IDENTITY}) AS n FROM parsed_credentials WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 72 HOUR")
def recent_unique(t: Tables) -> DataFrame:
    return since(t.parsed_credentials, "created_at", NOW, 3).agg(F.count_distinct(identity()).alias("n"))


FACETS = ("domain", "stealer_type", "application", "email_domain")


@query("SELECT facet, value, n FROM (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS r FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM parsed_credentials WHERE username ILIKE '%ko%' AND {c} IS NOT NULL GROUP BY 2" for c in FACETS) + ")) WHERE r <= 10")
def facets(t: Tables) -> DataFrame:
    """One pass: matching rows are unpivoted to (facet, value) and counted once."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in FACETS]))
    hits = t.parsed_credentials.filter(F.col("username").ilike("%ko%")).select(pairs.alias("p")).select("p.*").filter("value is not null")
    return top_per_group(hits.groupBy("facet", "value").agg(n_rows().alias("n")), "facet", "value", 10).drop("rank")


@query("SELECT count(DISTINCT domain) AS domains, count(DISTINCT email_domain) AS email_domains, count(DISTINCT credential_hash) AS hashes, count(*) AS records FROM parsed_credentials")
def distinct_totals(t: Tables) -> DataFrame:
    # one scan of one column for each count: together they would expand every row threefold
    p = t.parsed_credentials
    parts = [p.agg(F.count_distinct(c).alias("n")).select(F.lit(name).alias("what"), "n") for name, c in (("domains", "domain"), ("email_domains", "email_domain"), ("hashes", "credential_hash"))]
    parts.append(p.agg(n_rows().alias("n")).select(F.lit("records").alias("what"), "n"))
    return reduce(DataFrame.unionByName, parts).agg(*[F.max(F.when(F.col("what") == name, F.col("n"))).alias(name) for name in ("domains", "email_domains", "hashes", "records")])


@query("SELECT domain, count(*) AS n FROM parsed_credentials WHERE domain ILIKE '%hub%' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 50")
def domains_like(t: Tables) -> DataFrame:
    return top_n(t.parsed_credentials.filter(F.col("domain").ilike("%hub%")), ["domain"], n_rows(), 50)


@query("SELECT stealer_type, count(*) AS n, count(DISTINCT domain) AS domains, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct FROM parsed_credentials GROUP BY 1")
def type_share(t: Tables) -> DataFrame:
    by = t.parsed_credentials.groupBy("stealer_type").agg(n_rows().alias("n"), F.count_distinct("domain").alias("domains"))
    # one row for each type
    return by.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0))), 4))


@query("SELECT stealer_type, domain, n, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY stealer_type ORDER BY n DESC, domain) AS r FROM (SELECT stealer_type, domain, count(*) AS n FROM parsed_credentials WHERE domain IS NOT NULL AND stealer_type IS NOT NULL GROUP BY ALL)) WHERE r <= 5")
def topk_domains_per_type(t: Tables) -> DataFrame:
    by = t.parsed_credentials.filter("domain is not null and stealer_type is not null").groupBy("stealer_type", "domain").agg(n_rows().alias("n"))
    return top_per_group(by, "stealer_type", "domain", 5)


@query("SELECT c.title, p.stealer_type, count(*) AS n FROM parsed_credentials p JOIN channels c ON c.platform_id = p.source_conversation_id GROUP BY ALL")
def channel_by_type(t: Tables) -> DataFrame:
    n = t.parsed_credentials.groupBy("source_conversation_id", "stealer_type").agg(n_rows().alias("n"))
    return n.join(t.channels.select("platform_id", "title"), F.col("platform_id") == F.col("source_conversation_id")).groupBy("title", "stealer_type").agg(F.sum("n").alias("n"))


@query("SELECT strftime(log_date, '%Y-%m') AS month, " + ", ".join(f"count(*) FILTER (stealer_type = '{k}') AS {k}" for k in TYPES) + f", count(*) FILTER (stealer_type NOT IN ({', '.join(repr(k) for k in TYPES)})) AS other, count(stealer_type) AS total FROM system_info WHERE log_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
def monthly_types(t: Tables) -> DataFrame:
    return monthly_pivot(t.system_info, "log_date", "stealer_type", TYPES)


@query("SELECT l_returnflag AS code, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def diagnostics_errors(t: Tables) -> DataFrame:
    return top_n(t.lineitem.filter("l_linestatus = 'F'").withColumnRenamed("l_returnflag", "code"), ["code"], n_rows(), 10)


@query("SELECT conversation_id, count(DISTINCT coalesce('m' || platform_id, 'd' || delivery_id)) AS backlog, max(delivered_at) AS latest FROM messages WHERE text IS NULL GROUP BY 1")
def diagnostics_backlog(t: Tables) -> DataFrame:
    """Messages without a text; of one delivered several times only one counts, one without a number counts by itself."""
    message = F.coalesce(F.concat(F.lit("m"), F.col("platform_id").cast("string")), F.concat(F.lit("d"), F.col("delivery_id").cast("string")))
    one = t.messages.filter("text is null").groupBy("conversation_id", message.alias("m")).agg(F.max("delivered_at").alias("latest"))
    return one.groupBy("conversation_id").agg(n_rows().alias("backlog"), F.max("latest").alias("latest"))


@query("SELECT coalesce(sum(CASE WHEN is_member THEN 1 ELSE 0 END), 0) AS members, coalesce(sum(CASE WHEN is_accessible THEN 1 ELSE 0 END), 0) AS accessible, coalesce(sum(member_count), 0) AS people, count(*) AS channels FROM channels")
def channel_status(t: Tables) -> DataFrame:
    flag = lambda c: F.coalesce(F.sum(F.when(F.col(c), 1).otherwise(0)), F.lit(0)).cast("long")
    return t.channels.agg(flag("is_member").alias("members"), flag("is_accessible").alias("accessible"), F.coalesce(F.sum("member_count"), F.lit(0)).cast("long").alias("people"), n_rows().alias("channels"))


@query("SELECT conversation_type, count(*) AS n FROM channels GROUP BY 1")
def registry_by_source(t: Tables) -> DataFrame:
    return t.channels.groupBy("conversation_type").agg(n_rows().alias("n"))


@query("SELECT count(*) AS n, avg(p_size) AS mean_size, sum(p_size) AS total_size, sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS large FROM part")
def candidate_stats(t: Tables) -> DataFrame:
    return t.part.agg(n_rows().alias("n"), F.avg("p_size").alias("mean_size"), F.sum("p_size").alias("total_size"), F.sum(F.when(F.col("p_size") > 25, 1).otherwise(0)).alias("large"))


@query("SELECT platform_id, title FROM channels WHERE is_member AND NOT coalesce(is_accessible, false)")
def filter_flags(t: Tables) -> DataFrame:
    """Tri-state flags: given, denied or not asked for."""
    asked = {"is_member": True, "is_accessible": False, "absent": None}
    out = t.channels
    for c, want in asked.items():
        if want is not None:
            out = out.filter(F.coalesce(F.col(c), F.lit(False)) == want)
    return out.select("platform_id", "title")


# -- conditions on groups --------------------------------------------------------
@query("SELECT l_orderkey FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size > 45 GROUP BY 1 HAVING count(*) > 3 AND sum(CASE WHEN p.p_partkey IS NOT NULL THEN 1 ELSE 0 END) = 0")
def bad_groups(t: Tables) -> DataFrame:
    p = t.part.filter("p_size > 45").select("p_partkey")
    by = t.lineitem.select("l_orderkey", "l_partkey").join(p, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy("l_orderkey").agg(n_rows().alias("n"), F.count("p_partkey").alias("parts"))
    return by.filter("n > 3 and parts = 0").select("l_orderkey")


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) = 0 AND max(l_shipdate) < TIMESTAMP '1998-01-01'")
def stale_groups(t: Tables) -> DataFrame:
    by = t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("done"), F.max("l_shipdate").alias("last"))
    return by.filter((F.col("done") == 0) & (F.col("last") < F.lit("1998-01-01").cast("timestamp"))).select("l_orderkey")


@query("SELECT o_orderkey FROM orders ANTI JOIN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_linestatus = 'F') = 0) s ON s.l_orderkey = o_orderkey")
def not_stale(t: Tables) -> DataFrame:
    stale = t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("done")).filter("done = 0")
    return t.orders.join(stale, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


TOKENS = ("archive", "report")


@query("SELECT doc_id FROM (" + " UNION ALL ".join(f"SELECT doc_id, {i} AS token FROM documents WHERE text ILIKE '%{w}%'" for i, w in enumerate(TOKENS)) + ") GROUP BY 1 HAVING count(DISTINCT token) = 2")
def multi_token_division(t: Tables) -> DataFrame:
    """Relational division: rows tagged by the token they match, kept if they match all."""
    tags = F.explode(F.array_compact(F.array(*[F.when(F.col("text").ilike(f"%{w}%"), F.lit(i)) for i, w in enumerate(TOKENS)])))
    return t.documents.select("doc_id", tags.alias("token")).groupBy("doc_id").agg(F.count_distinct("token").alias("k")).filter(F.col("k") == len(TOKENS)).select("doc_id")


GROUPS = "(SELECT l_orderkey AS k, min(CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END) AS priority, count(*) FILTER (l_linestatus = 'O') AS pending, count(*) FILTER (l_linestatus = 'F') AS done, max(l_shipdate) AS latest FROM lineitem GROUP BY 1)"
STALE_BEFORE = "1996-01-01"


def _work(t: Tables) -> DataFrame:
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    by = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(rank).alias("priority"), F.count_if(F.col("l_linestatus") == "O").alias("pending"), F.count_if(F.col("l_linestatus") == "F").alias("done"), F.max("l_shipdate").alias("latest"))
    return t.orders.select("o_orderkey").join(by.filter("pending > 0"), "o_orderkey")


@query(f"SELECT o_orderkey, priority, pending FROM orders JOIN {GROUPS} ON k = o_orderkey WHERE pending > 0 AND done > 0 ORDER BY priority, pending, 1 LIMIT 50")
def ready_order(t: Tables) -> DataFrame:
    """Work to pick next: partly done groups by best priority, then fewest pending."""
    return _work(t).filter("done > 0").select("o_orderkey", "priority", "pending").orderBy("priority", "pending", "o_orderkey").limit(50)


@query(f"""SELECT way, o_orderkey FROM (SELECT * FROM (SELECT 0 AS way, o_orderkey, priority, pending, latest FROM orders JOIN {GROUPS} ON k = o_orderkey WHERE pending > 0 AND done > 0
 UNION ALL SELECT 1, o_orderkey, priority, pending, latest FROM orders JOIN {GROUPS} ON k = o_orderkey WHERE pending > 0 AND done = 0 AND latest >= TIMESTAMP '{STALE_BEFORE}')
 ORDER BY way, priority, CASE WHEN way = 0 THEN pending ELSE -epoch_us(latest) END, o_orderkey LIMIT 1)""")
def next_work(t: Tables) -> DataFrame:
    """The one group to work on next.

    A partly done group by priority, then fewest pending; if there is none, an
    untouched one by priority, then newest, unless it is stale.
    """
    w = _work(t)
    fallback = w.filter((F.col("done") == 0) & (F.col("latest") >= F.lit(STALE_BEFORE).cast("timestamp"))).select(F.lit(1).alias("way"), "o_orderkey", "priority", (-F.unix_micros("latest")).alias("then"))
    first = w.filter("done > 0").select(F.lit(0).alias("way"), "o_orderkey", "priority", F.col("pending").alias("then"))
    return first.unionByName(fallback).orderBy("way", "priority", "then", "o_orderkey").limit(1).select("way", "o_orderkey")


@query(f"""SELECT o_orderkey, priority FROM orders JOIN {GROUPS} ON k = o_orderkey WHERE pending > 0 AND done = 0 AND latest >= TIMESTAMP '{STALE_BEFORE}' ORDER BY priority, latest DESC, 1 LIMIT 50""")
def fallback_order(t: Tables) -> DataFrame:
    """Untouched groups that are not stale, by priority, then newest."""
    w = _work(t).filter((F.col("done") == 0) & (F.col("latest") >= F.lit(STALE_BEFORE).cast("timestamp")))
    return w.orderBy("priority", F.desc("latest"), "o_orderkey").limit(50).select("o_orderkey", "priority")


@query("""WITH x AS (SELECT l_orderkey, l_partkey, bool_or(l_linestatus = 'F') OVER (PARTITION BY l_orderkey, l_suppkey) AS twin_done, l_linestatus, l_returnflag FROM lineitem)
SELECT l_orderkey, CASE WHEN bool_and(l_linestatus = 'F' OR (l_returnflag = 'R' AND twin_done)) THEN 'READY' WHEN bool_or(l_linestatus = 'O') THEN 'WAITING' ELSE 'FAILED' END AS state FROM x GROUP BY 1""")
def group_readiness(t: Tables) -> DataFrame:
    """Ready if every part is complete, or given up on but covered by a complete twin."""
    twin = F.bool_or(F.col("l_linestatus") == "F").over(Window.partitionBy("l_orderkey", "l_suppkey"))
    x = t.lineitem.select("l_orderkey", "l_suppkey", "l_linestatus", "l_returnflag").withColumn("twin", twin)
    ready = F.every((F.col("l_linestatus") == "F") | ((F.col("l_returnflag") == "R") & F.col("twin")))
    return x.groupBy("l_orderkey").agg(F.when(ready, "READY").when(F.bool_or(F.col("l_linestatus") == "O"), "WAITING").otherwise("FAILED").alias("state"))


@query("SELECT l_orderkey, substr(sha256(string_agg(k, '|' ORDER BY k)), 1, 16) AS fingerprint FROM (SELECT DISTINCT l_orderkey, CAST(l_partkey AS VARCHAR) AS k FROM lineitem) GROUP BY 1")
def fingerprint(t: Tables) -> DataFrame:
    keys = F.array_sort(F.collect_set(F.col("l_partkey").cast("string")))
    return t.lineitem.groupBy("l_orderkey").agg(F.substring(F.sha2(F.concat_ws("|", keys), 256), 1, 16).alias("fingerprint"))


@query("SELECT max(delivery_id) AS last_delivery, max(platform_id) AS last_message FROM messages")
def high_marks(t: Tables) -> DataFrame:
    return t.messages.agg(F.max("delivery_id").alias("last_delivery"), F.max("platform_id").alias("last_message"))


@query("SELECT batch_id, count(DISTINCT domain) AS domains, count(*) AS n FROM parsed_credentials GROUP BY 1")
def batch_domains(t: Tables) -> DataFrame:
    return t.parsed_credentials.groupBy("batch_id").agg(F.count_distinct("domain").alias("domains"), n_rows().alias("n"))


@query("SELECT batch_id, domain, n, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, domain) AS r FROM (SELECT batch_id, domain, count(*) AS n FROM parsed_credentials WHERE domain IS NOT NULL GROUP BY ALL)) WHERE r <= 5")
def batch_top_domains(t: Tables) -> DataFrame:
    by = t.parsed_credentials.filter("domain is not null").groupBy("batch_id", "domain").agg(n_rows().alias("n"))
    return top_per_group(by, "batch_id", "domain", 5)


# -- extras Spark brings along -----------------------------------------------------
@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_status(t: Tables) -> DataFrame:
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(n_rows().alias("n"), F.sum("l_quantity").alias("qty"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_status(t: Tables) -> DataFrame:
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(n_rows().alias("n"))
