"""Search, filters, joins, de-duplication, watch lists and work queues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text
from siltstone.operators import dedup, search, watch
from siltstone.operators.stats import late_lookup
from siltstone.plans.registry import Registry, Tables
from siltstone.plans.stats_queries import ONCE, once
from siltstone.sources import sinks

registry = Registry()
query = registry.query
NOW = "2017-03-31 00:00:00"
SHOWN = ["id", "domain", "username", "stealer_type"]
ANY = "(domain ILIKE '%{0}%' OR username ILIKE '%{0}%' OR email_domain ILIKE '%{0}%')"


@query(f"SELECT id, domain, username, stealer_type FROM parsed_credentials WHERE {ANY.format('shop')} AND {ANY.format('ko')} ORDER BY id DESC LIMIT 200")
def search_tokens(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter(search.predicate("shop ko")).select(SHOWN).orderBy(F.desc("id")).limit(200)


@query(f"SELECT id, domain, username, stealer_type FROM parsed_credentials WHERE {ANY.format('mail')} AND (domain ILIKE '%shop%' OR domain ILIKE '%hub%') AND stealer_type ILIKE '%elm%' AND created_at >= TIMESTAMP '2017-03-10' ORDER BY id DESC LIMIT 200")
def search_filtered(t: Tables) -> DataFrame:
    """Filters act before the limit, so a full page comes out if there is one."""
    return t.parsed_credentials.filter(search.predicate("mail domain:shop domain:hub stealer:elm since:2017-03-10 since:never")).select(SHOWN).orderBy(F.desc("id")).limit(200)


@query(f"SELECT id, domain, username, stealer_type FROM parsed_credentials WHERE {ANY.format('post')} ORDER BY created_at DESC, id DESC LIMIT 25 OFFSET 50")
def search_paged(t: Tables) -> DataFrame:
    """The third page of 25: the offset is taken once."""
    hits = t.parsed_credentials.filter(search.predicate("post"))
    return search.page(hits, [F.desc("created_at"), F.desc("id")], 25, 3).select(SHOWN)


@query(f"SELECT greatest(1, CAST(ceil(count(*) / 25.0) AS BIGINT)) AS pages FROM parsed_credentials WHERE {ANY.format('post')}")
def search_pages(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter(search.predicate("post")).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / 25)).cast("long").alias("pages"))


@query(f"SELECT id, domain, username, stealer_type FROM parsed_credentials WHERE {ANY.format('post')} AND id < 5000 ORDER BY id DESC LIMIT 50")
def search_keyset(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter(search.predicate("post") & (F.col("id") < 5000)).select(SHOWN).orderBy(F.desc("id")).limit(50)


#: The eight fields that a word or pattern is looked for in.
EIGHT = ("url", "domain", "username", "email_domain", "application", "profile", "source_file", "stealer_type")


@query("SELECT id, domain, username, stealer_type FROM parsed_credentials WHERE " + " OR ".join(f"coalesce(regexp_matches({c}, '(?i)^(shop|mail|elm)\\.?'), false)" for c in EIGHT))
def search_regex(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter(search.matches_any(r"^(shop|mail|elm)\.?", EIGHT)).select(SHOWN)


@query("SELECT id FROM parsed_credentials WHERE " + " OR ".join(f"{c} ILIKE '%hub%'" for c in EIGHT))
def like_any(t: Tables) -> DataFrame:
    """A word in any of eight fields: one condition, one scan."""
    return t.parsed_credentials.filter(search.predicate("hub", EIGHT)).select("id")


SAVED = (("hubs", "hub"), ("late mail", "mail since:2017-03-10"), ("shops of elm", "domain:shop stealer:elm"))


@query(f"SELECT 'hubs' AS name, id FROM parsed_credentials WHERE {ANY.format('hub')} UNION ALL SELECT 'late mail', id FROM parsed_credentials WHERE {ANY.format('mail')} AND created_at >= TIMESTAMP '2017-03-10' UNION ALL SELECT 'shops of elm', id FROM parsed_credentials WHERE domain ILIKE '%shop%' AND stealer_type ILIKE '%elm%'")
def saved_searches(t: Tables) -> DataFrame:
    """Searches saved, one of them anew, one removed, and all that are left run in one scan."""
    held = search.SavedSearches(t.spark)
    held.save("hubs", "something else")
    held.save("gone", "x")
    for name, q in SAVED:
        held.save(name, q)
    held.remove("gone")
    return held.run(t.parsed_credentials).select("name", "id")


FEDERATED = (
    ("channels", "platform_id", ("title", "username")),
    ("messages", "delivery_id", ("text", "caption", "post_author")),
    ("file_attachments", "id", ("filename", "mime_type")),
    ("parsed_credentials", "id", ("domain", "username", "email_domain", "application", "source_file")),
    ("system_info", "id", ("hostname", "username", "country", "os")),
    ("documents", "doc_id", ("text", "source")),
    ("benchmark_items", "item_id", ("text", "suite")),
)


@query(" UNION ALL ".join(f"SELECT '{n}' AS entity, CAST({k} AS BIGINT) AS key, array_to_string(list_filter([{', '.join(f'CASE WHEN {c} ILIKE {chr(39)}%archive%{chr(39)} THEN {chr(39)}{c}{chr(39)} END' for c in cs)}], lambda x: x IS NOT NULL), ',') AS fields FROM {n} WHERE {' OR '.join(f'{c} ILIKE {chr(39)}%archive%{chr(39)}' for c in cs)}" for n, k, cs in FEDERATED))
def search_federated(t: Tables) -> DataFrame:
    """Seven entities under one schema, each searched in all its columns of text."""
    out = None
    for name, key, columns in FEDERATED:
        where = F.array_compact(F.array(*[F.when(F.col(c).ilike("%archive%"), F.lit(c)) for c in columns]))
        part = getattr(t, name).filter(search.predicate("archive", columns)).select(F.lit(name).alias("entity"), F.col(key).cast("long").alias("key"), F.array_join(where, ",").alias("fields"))
        out = part if out is None else out.unionByName(part)
    return out


MESSAGES = "(text ILIKE '%folder%' OR caption ILIKE '%folder%' OR post_author ILIKE '%folder%')"


@query(f"SELECT delivery_id FROM messages WHERE {MESSAGES} AND (conversation_id IS NULL OR conversation_id NOT IN (SELECT platform_id FROM channels WHERE lower(title) LIKE '%folder%' OR lower(username) LIKE '%folder%')) ORDER BY platform_timestamp DESC, delivery_id DESC LIMIT 100")
def search_messages(t: Tables) -> DataFrame:
    """Text, caption and author, without the channels that are left out; these go before the limit."""
    hits = search.without_sources(t.messages.filter(search.predicate("folder", ("text", "caption", "post_author"))), "conversation_id", _excluded(t))
    return hits.orderBy(F.desc("platform_timestamp"), F.desc("delivery_id")).limit(100).select("delivery_id")


BM_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


@query(f"""WITH d AS (SELECT doc_id, {BM_WORDS} AS w FROM documents), c AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'archive')) AS a, len(list_filter(w, lambda x: x = 'channel')) AS b FROM d),
 s AS (SELECT count(*) AS docs, avg(n) AS mean, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM c)
SELECT doc_id, round(ln(1 + (docs - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean)) + ln(1 + (docs - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / mean)), 6) AS score
FROM c, s WHERE a > 0 OR b > 0""")
def search_bm25(t: Tables) -> DataFrame:
    return search.bm25(t.documents, "doc_id", "text", ["archive", "channel"])


@query("SELECT id FROM parsed_credentials WHERE stealer_type = 'elm' AND application ILIKE '%browser%' AND email_domain ILIKE '%mail%'")
def filter_exact_and_like(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter((F.col("stealer_type") == "elm") & F.col("application").ilike("%browser%") & F.col("email_domain").ilike("%mail%")).select("id")


EXCLUDED = "(SELECT platform_id FROM channels WHERE lower(title) LIKE '%folder%' OR lower(username) LIKE '%folder%')"


def _excluded(t: Tables) -> DataFrame:
    return t.channels.filter(F.lower("title").contains("folder") | F.lower("username").contains("folder")).select("platform_id")


@query(f"SELECT id FROM parsed_credentials WHERE source_conversation_id IS NULL OR source_conversation_id NOT IN {EXCLUDED}")
def exclude_keep_null(t: Tables) -> DataFrame:
    return search.without_sources(t.parsed_credentials.select("id", "source_conversation_id"), "source_conversation_id", _excluded(t)).select("id")


@query(f"SELECT id FROM parsed_credentials WHERE source_conversation_id NOT IN {EXCLUDED}")
def exclude_drop_null(t: Tables) -> DataFrame:
    return search.without_sources(t.parsed_credentials.select("id", "source_conversation_id"), "source_conversation_id", _excluded(t), keep_null=False).select("id")


@query(f"SELECT id FROM parsed_credentials WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 48 HOUR")
def since_filter(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter(search.predicate("since:48h", now=NOW)).select("id")


@query("SELECT platform_id FROM channels WHERE (title ILIKE '%archive%' OR username ILIKE '%archive%') AND NOT (coalesce(title, '') ILIKE '%signed%' OR coalesce(username, '') ILIKE '%signed%')")
def include_exclude_words(t: Tables) -> DataFrame:
    has = lambda w: F.coalesce(F.col("title"), F.lit("")).ilike(f"%{w}%") | F.coalesce(F.col("username"), F.lit("")).ilike(f"%{w}%")
    return t.channels.filter(has("archive") & ~has("signed")).select("platform_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_filter(t: Tables) -> DataFrame:
    r = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey")
    return t.orders.filter(F.col("o_orderstatus").isin("F", "P")).join(r, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderkey")


# -- joins ---------------------------------------------------------------------
@query("SELECT a.id FROM file_attachments a WHERE NOT EXISTS (SELECT 1 FROM messages m WHERE m.conversation_id = a.conversation_id AND m.platform_id = a.message_id)")
def attachments_without_message(t: Tables) -> DataFrame:
    m = t.messages.select("conversation_id", F.col("platform_id").alias("message_id"))
    return t.file_attachments.join(m, ["conversation_id", "message_id"], "left_anti").select("id")


@query(f"SELECT c.platform_id, coalesce(m.n, 0) AS messages, coalesce(r.n, 0) AS records FROM channels c LEFT JOIN (SELECT conversation_id, count(*) AS n FROM {ONCE} GROUP BY 1) m ON m.conversation_id = c.platform_id LEFT JOIN (SELECT source_conversation_id, count(*) AS n FROM parsed_credentials GROUP BY 1) r ON r.source_conversation_id = c.platform_id")
def channel_counts(t: Tables) -> DataFrame:
    """Each fact is counted before it meets the dimension; a message counts once."""
    m = once(t).groupBy(F.col("conversation_id").alias("platform_id")).agg(F.count(F.lit(1)).alias("m"))
    r = t.parsed_credentials.groupBy(F.col("source_conversation_id").alias("platform_id")).agg(F.count(F.lit(1)).alias("r"))
    return t.channels.select("platform_id").join(m, "platform_id", "left").join(r, "platform_id", "left").select("platform_id", F.coalesce("m", F.lit(0)).alias("messages"), F.coalesce("r", F.lit(0)).alias("records"))


@query(f"SELECT c.platform_id, c.title, count(m.platform_id) AS messages, count(src) AS forwarded, max(ts) AS latest FROM channels c LEFT JOIN {ONCE} m ON m.conversation_id = c.platform_id GROUP BY ALL")
def conversation_detail(t: Tables) -> DataFrame:
    m = once(t).groupBy(F.col("conversation_id").alias("platform_id")).agg(F.count(F.lit(1)).alias("m"), F.count("src").alias("f"), F.max("ts").alias("latest"))
    count = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    return t.channels.select("platform_id", "title").join(m, "platform_id", "left").select("platform_id", "title", count("m", "messages"), count("f", "forwarded"), "latest")


@query("SELECT o_orderkey, bool_or(l_linestatus <> 'F') AS open FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1")
def any_open(t: Tables) -> DataFrame:
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_linestatus").join(t.part.select("p_partkey"), F.col("p_partkey") == F.col("l_partkey"), "left")
    return t.orders.select("o_orderkey").join(l, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("o_orderkey").agg(F.bool_or(F.col("l_linestatus") != "F").alias("open"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')")
def recoverable(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderstatus")
    on = F.col("o_custkey") == F.col("c_custkey")
    return t.customer.join(o.filter("o_orderstatus = 'P'"), on, "left_semi").join(o.filter("o_orderstatus = 'O'"), on, "left_anti").select("c_custkey")


@query("""WITH m AS (SELECT DISTINCT conversation_id AS g, platform_id AS p FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL)
SELECT g AS conversation_id, p AS platform_id, near, distance FROM (SELECT a.g, a.p, b.p AS near, abs(a.p - b.p) AS distance, row_number() OVER (PARTITION BY a.g, a.p ORDER BY abs(a.p - b.p), b.p) AS r FROM m a JOIN m b ON a.g = b.g AND a.p <> b.p) WHERE r <= 4""")
def nearest_messages(t: Tables) -> DataFrame:
    return dedup.nearest(once(t), "conversation_id", "platform_id", 2)


@query("""WITH x AS (SELECT source_conversation_id AS c, count(*) AS n FROM parsed_credentials WHERE source_conversation_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10) SELECT c AS conversation_id, n, title FROM x LEFT JOIN channels ON platform_id = c""")
def late_names(t: Tables) -> DataFrame:
    top = t.parsed_credentials.filter("source_conversation_id is not null").groupBy(F.col("source_conversation_id").alias("conversation_id")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "conversation_id").limit(10)
    return late_lookup(top, t.channels.select("platform_id", "title"), F.col("platform_id") == F.col("conversation_id")).drop("platform_id")


# -- de-duplication ----------------------------------------------------------------
@query("SELECT credential_hash, min(id) AS id FROM parsed_credentials WHERE credential_hash IS NOT NULL GROUP BY 1")
def dedup_hash(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter("credential_hash is not null").groupBy("credential_hash").agg(F.min("id").alias("id"))


SOFT = "coalesce(soft_credential_hash, credential_hash, CAST(id AS VARCHAR))"


@query(f"SELECT id, domain FROM (SELECT *, row_number() OVER (PARTITION BY {SOFT} ORDER BY created_at DESC, id DESC) AS r FROM parsed_credentials WHERE {ANY.format('post')}) WHERE r = 1 ORDER BY created_at DESC, id DESC LIMIT 100")
def dedup_soft(t: Tables) -> DataFrame:
    """Duplicates go before the limit, so the page is full."""
    order = (F.desc("created_at"), F.desc("id"))
    return search.keep_first(t.parsed_credentials.filter(search.predicate("post")), search.identity(), *order).orderBy(*order).limit(100).select("id", "domain")


@query("WITH s AS (SELECT * FROM parsed_credentials WHERE batch_id > 20), t AS (SELECT DISTINCT credential_hash FROM parsed_credentials WHERE batch_id <= 20 AND credential_hash IS NOT NULL) SELECT min(id) AS id FROM s WHERE credential_hash IS NOT NULL AND credential_hash NOT IN (SELECT credential_hash FROM t) GROUP BY credential_hash UNION ALL SELECT id FROM s WHERE credential_hash IS NULL")
def anti_insert(t: Tables) -> DataFrame:
    p = t.parsed_credentials.select("id", "batch_id", "credential_hash")
    return dedup.new_rows(p.filter("batch_id > 20"), p.filter("batch_id <= 20"), "credential_hash", F.col("id")).select("id")


ACCOUNT = "WITH f AS (SELECT b AS batch_id, count(*) AS k FROM (SELECT credential_hash, min(batch_id) AS b FROM parsed_credentials WHERE credential_hash IS NOT NULL GROUP BY 1) GROUP BY 1), n AS (SELECT batch_id, count(*) AS n, count(*) FILTER (credential_hash IS NULL) AS z FROM parsed_credentials GROUP BY 1), a AS (SELECT n.batch_id, n, coalesce(k, 0) + z AS new, n - coalesce(k, 0) - z AS dup FROM n LEFT JOIN f USING (batch_id))"


@query(ACCOUNT + " SELECT * FROM a")
def dup_accounting(t: Tables) -> DataFrame:
    return dedup.accounting(t.parsed_credentials, "credential_hash", "batch_id")


LOADS = """WITH f AS (SELECT *, min(id) OVER (PARTITION BY credential_hash) AS first_id FROM parsed_credentials),
 a AS (SELECT extraction_job_id AS job, batch_id, count(*) AS n, count(*) FILTER (credential_hash IS NULL OR id = first_id) AS new, count(*) FILTER (credential_hash IS NOT NULL AND id <> first_id) AS dup FROM f GROUP BY ALL),
 d AS (SELECT *, new + dup >= {0} / 2 AND dup >= {1} * (new + dup) AS full_of_copies FROM a),
 r AS (SELECT *, sum(CAST(full_of_copies AS INT)) OVER (PARTITION BY job ORDER BY batch_id ROWS BETWEEN {2} PRECEDING AND CURRENT ROW) = {2} + 1 AS stop FROM d)
SELECT job AS extraction_job_id, batch_id, full_of_copies, coalesce(bool_or(stop) OVER (PARTITION BY job ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS skipped FROM r"""


def _skips(t: Tables, size, share: float, after: int) -> DataFrame:
    a = dedup.load_accounting(t.parsed_credentials.select("id", "extraction_job_id", "batch_id", "credential_hash"), "credential_hash", "extraction_job_id", "batch_id", "id")
    return dedup.early_skips(a, "extraction_job_id", "batch_id", size, share, after).select("extraction_job_id", "batch_id", F.col("full").alias("full_of_copies"), "skipped")


@query(LOADS.format("20000", "0.95", "2"))
def early_skip_runs(t: Tables) -> DataFrame:
    """Batches of a load that were seen at least by half and were duplicates for 95 percent; behind three in a row the load is skipped."""
    return _skips(t, F.lit(20_000), 0.95, 3)


@query(LOADS.format("n", "0.5", "1"))
def early_skip_small(t: Tables) -> DataFrame:
    """The same for the batches of these tables: half duplicates, two in a row."""
    return _skips(t, F.col("n"), 0.5, 2)


@query("SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) - 1 >= 2)")
def preskip_files(t: Tables) -> DataFrame:
    """Inputs whose content was a duplicate twice or more are dropped before any parsing."""
    d = t.documents.filter("text is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    known = d.groupBy("h").agg((F.count(F.lit(1)) - 1).alias("again")).filter("again >= 2")
    return d.join(known, "h", "left_anti").select("doc_id")


@query("SELECT id FROM parsed_credentials p WHERE NOT EXISTS (SELECT 1 FROM parsed_credentials o WHERE o.batch_id <= 12 AND o.extraction_job_id = p.extraction_job_id AND o.source_file = p.source_file) AND batch_id > 12")
def skip_parsed_files(t: Tables) -> DataFrame:
    """Rows of files that no earlier load of the same job has parsed; a row without a job or file is never known."""
    p = t.parsed_credentials.select("id", "batch_id", "extraction_job_id", "source_file")
    parsed = p.filter("batch_id <= 12").select("extraction_job_id", "source_file").distinct()
    return p.filter("batch_id > 12").join(parsed, ["extraction_job_id", "source_file"], "left_anti").select("id")


@query("SELECT h, f.at AS first, f.conversation_id AS conversation_id, f.doc_id AS doc_id, duplicates FROM (SELECT sha256(text) AS h, arg_min({'at': platform_timestamp, 'conversation_id': conversation_id, 'doc_id': doc_id}, (platform_timestamp IS NULL, platform_timestamp, doc_id)) AS f, count(*) - 1 AS duplicates FROM documents WHERE text IS NOT NULL GROUP BY 1)")
def first_seen(t: Tables) -> DataFrame:
    """Every text; rows without a time come last, a conversation may be null."""
    return dedup.first_seen(t.documents, F.sha2("text", 256), "platform_timestamp", ["conversation_id", "doc_id"], "doc_id")


@query(r"SELECT lower(regexp_replace(hostname, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS k, min(id) AS id FROM system_info WHERE hostname IS NOT NULL GROUP BY 1")
def keep_first_ci(t: Tables) -> DataFrame:
    """Every hostname, those of other scripts as well."""
    s = t.system_info.filter("hostname is not null").withColumn("k", F.lower(text.stripped(F.col("hostname"))))
    return search.keep_first(s, F.col("k"), F.col("id")).select("k", "id")


@query("SELECT coalesce(credential_hash, id || ':' || line_number) AS k, min(id) AS id FROM parsed_credentials GROUP BY 1")
def attachment_identity(t: Tables) -> DataFrame:
    k = F.coalesce("credential_hash", F.concat_ws(":", "id", "line_number"))
    return t.parsed_credentials.groupBy(k.alias("k")).agg(F.min("id").alias("id"))


@query("SELECT hostname, id, country FROM (SELECT *, row_number() OVER (PARTITION BY hostname ORDER BY log_date DESC NULLS LAST, id DESC) AS r FROM system_info WHERE hostname IS NOT NULL) WHERE r = 1")
def upsert_latest(t: Tables) -> DataFrame:
    return dedup.latest(t.system_info, "hostname", F.desc_nulls_last("log_date"), F.desc("id")).select("hostname", "id", "country")


NAMED = "coalesce(text, '') || ' @' || source || ' t.me/' || source || '_x1'"


@query(f"""WITH x AS (SELECT {NAMED} AS x FROM documents), n AS (SELECT DISTINCT unnest(list_distinct(list_filter(list_concat(list_transform(regexp_extract_all(x, '@({text.HANDLE})', 1), lambda y: lower(y)), list_transform(regexp_extract_all(x, '{text.NAME_LINK}', 1), lambda y: lower(y))), lambda y: y NOT IN ({', '.join(repr(w) for w in text.NO_CHANNELS)})))) AS name FROM x),
 b AS (SELECT lower(username) AS name, min(platform_id) AS id FROM channels GROUP BY 1),
 d AS (SELECT CAST(platform_id AS VARCHAR) AS c, 0 AS p, 'member' AS origin FROM channels WHERE is_member UNION ALL SELECT DISTINCT CAST(forwarded_from_id AS VARCHAR), 1, 'forwarded' FROM messages WHERE forwarded_from_id IS NOT NULL
 UNION ALL SELECT coalesce(CAST(b.id AS VARCHAR), '@' || n.name), 2, 'mention' FROM n LEFT JOIN b ON b.name = n.name UNION ALL SELECT DISTINCT CAST(conversation_id AS VARCHAR), 3, 'attachment' FROM file_attachments WHERE conversation_id IS NOT NULL)
SELECT c AS channel, arg_min(origin, p) AS origin FROM d GROUP BY 1""")
def discovery_union(t: Tables) -> DataFrame:
    """Channels by four sources, the first that has one: membership, forwards, names mentioned or linked, attachments.

    A name that belongs to a known channel stands for its number, any other for itself.
    """
    return discovery(t.channels, t.messages, t.documents.select(F.concat(F.coalesce("text", F.lit("")), F.lit(" @"), "source", F.lit(" t.me/"), "source", F.lit("_x1")).alias("x")), "x", t.file_attachments)


def discovery(channels: DataFrame, messages: DataFrame, texts: DataFrame, column: str, attachments: DataFrame) -> DataFrame:
    number = lambda df, c, origin: df.filter(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("channel"), F.lit(origin).alias("origin")).distinct()
    names = texts.select(F.explode(F.array_union(text.mentions(F.col(column)), text.linked_names(F.col(column)))).alias("name")).distinct()
    known = channels.filter("username is not null").groupBy(F.lower("username").alias("name")).agg(F.min("platform_id").cast("string").alias("id"))
    mentioned = names.join(known, "name", "left").select(F.coalesce("id", F.concat(F.lit("@"), "name")).alias("channel"), F.lit("mention").alias("origin"))
    return dedup.union_by_priority([number(channels.filter("is_member"), "platform_id", "member"), number(messages, "forwarded_from_id", "forwarded"), mentioned, number(attachments, "conversation_id", "attachment")], "channel")


RESOLVED = """WITH k AS (SELECT platform_id, lower(username) AS name, lower(title) AS title FROM channels), c AS (SELECT doc_id, conversation_id AS platform_id, lower(source) AS name, lower(lang) AS lang, text FROM documents),
 u AS (SELECT name, min(platform_id) AS i FROM k WHERE name IS NOT NULL GROUP BY 1), l AS (SELECT title, min(platform_id) AS i FROM k WHERE title IS NOT NULL GROUP BY 1),
 r AS (SELECT c.*, coalesce(k.platform_id, u.i, l.i) AS resolved FROM c LEFT JOIN k ON k.platform_id = c.platform_id LEFT JOIN u ON u.name = c.name LEFT JOIN l ON l.title = c.name)"""


def _resolved(t: Tables) -> DataFrame:
    c = t.documents.select("doc_id", F.col("conversation_id").alias("platform_id"), F.lower("source").alias("name"), F.lower("source").alias("link"))
    k = t.channels.select(F.col("platform_id").alias("pid"), "platform_id", F.lower("username").alias("name"), F.lower("title").alias("link"))
    return dedup.resolve(c, k, ["platform_id", "name", "link"], "pid")


@query(RESOLVED + " SELECT doc_id, resolved FROM r")
def entity_resolve(t: Tables) -> DataFrame:
    """By number, else by name in lower case, else by what stands for an invitation link, the title."""
    return _resolved(t).select("doc_id", "resolved")


@query(RESOLVED + " SELECT h.platform_id, coalesce(h.username, f.name) AS username, h.title FROM channels h LEFT JOIN (SELECT resolved, arg_min(name, doc_id) AS name FROM r WHERE name IS NOT NULL AND resolved IS NOT NULL GROUP BY 1) f ON f.resolved = h.platform_id")
def entity_fill(t: Tables) -> DataFrame:
    """Known channels take what they lack from what was resolved to them, and keep what they have."""
    found = _resolved(t).select(F.col("resolved").alias("platform_id"), F.col("name").alias("username"), "doc_id")
    return dedup.fill_missing(t.channels.select("platform_id", "username", "title"), found, "platform_id", ["username"], "doc_id")


@query("SELECT p.id, coalesce(p.stealer_type, s.t) AS stealer_type FROM parsed_credentials p LEFT JOIN (SELECT extraction_job_id AS j, min(stealer_type) AS t FROM system_info WHERE stealer_type IS NOT NULL GROUP BY 1) s ON s.j = p.extraction_job_id")
def backfill_labels(t: Tables) -> DataFrame:
    s = t.system_info.filter("stealer_type is not null").groupBy("extraction_job_id").agg(F.min("stealer_type").alias("t"))
    return t.parsed_credentials.select("id", "extraction_job_id", "stealer_type").join(s, "extraction_job_id", "left").select("id", F.coalesce("stealer_type", "t").alias("stealer_type"))


@query("SELECT id FROM parsed_credentials WHERE domain ILIKE '%shop%' INTERSECT SELECT id FROM parsed_credentials WHERE username ILIKE '%ko%'")
def intersect_ids(t: Tables) -> DataFrame:
    p = t.parsed_credentials
    return p.filter(F.col("domain").ilike("%shop%")).select("id").intersect(p.filter(F.col("username").ilike("%ko%")).select("id"))


@query("SELECT id FROM parsed_credentials WHERE domain ILIKE '%hub%' UNION SELECT id FROM parsed_credentials WHERE username ILIKE '%hub%' UNION SELECT id FROM parsed_credentials WHERE url ILIKE '%hub%'")
def union_dedup(t: Tables) -> DataFrame:
    p = t.parsed_credentials
    parts = [p.filter(F.col(c).ilike("%hub%")).select("id") for c in ("domain", "username", "url")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query("SELECT id FROM parsed_credentials WHERE domain ILIKE '%hub%' EXCEPT SELECT id FROM parsed_credentials WHERE email_domain IS NULL")
def except_ids(t: Tables) -> DataFrame:
    p = t.parsed_credentials
    return p.filter(F.col("domain").ilike("%hub%")).select("id").exceptAll(p.filter("email_domain is null").select("id")).distinct()


@query("SELECT l_orderkey, l_linenumber FROM lineitem ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') c ON c.o_orderkey = l_orderkey")
def prune_done(t: Tables) -> DataFrame:
    """A delete is a rewrite without the rows that are done."""
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey")
    return t.lineitem.join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("l_orderkey", "l_linenumber")


# -- watch lists ----------------------------------------------------------------------
ITEMS = ((1, "shop", "domain", 3, 1, "2017-03-05 00:00:00"), (2, "mailorn", "any", 0, 0, "2017-03-20 00:00:00"), (3, "KO", "user", 5, 2, None), (4, "login", "url", 10, 0, "2017-03-28 00:00:00"), (5, "zzzz", "other", 2, 0, "2017-03-01 00:00:00"))
ITEM_SQL = "(VALUES " + ", ".join(f"({i}, '{q}', '{m}', {k}, {n}, {'NULL' if at is None else f'TIMESTAMP {at!r}'})" for i, q, m, k, n, at in ITEMS) + ") i(item_id, query, match_type, last_count, new_count, mark_at)"
HIT = " OR ".join(f"({'match_type NOT IN (' + chr(39) + 'domain' + chr(39) + ', ' + chr(39) + 'user' + chr(39) + ', ' + chr(39) + 'url' + chr(39) + ')' if k == 'any' else f'match_type = {k!r}'} AND ({' OR '.join(f'contains(lower({c}), lower(query))' for c in cols)}))" for k, cols in watch.BY_TYPE.items())


def watch_items(t: Tables) -> DataFrame:
    df = t.spark.createDataFrame([tuple(r) for r in ITEMS], "item_id long, query string, match_type string, last_count long, new_count long, at string")
    return df.withColumn("last_checked_at", F.col("at").cast("timestamp")).drop("at")


RECORDS = ["id", "domain", "username", "url", "email_domain", "created_at", "soft_credential_hash", "credential_hash"]


@query(f"SELECT item_id, count(DISTINCT {SOFT}) AS total, greatest(0, count(DISTINCT {SOFT}) - any_value(last_count)) AS new FROM {ITEM_SQL} LEFT JOIN parsed_credentials p ON {HIT} GROUP BY 1".replace(f"count(DISTINCT {SOFT})", f"count(DISTINCT CASE WHEN p.id IS NOT NULL THEN {SOFT} END)"))
def theta_watch_counts(t: Tables) -> DataFrame:
    return watch.sweep(watch_items(t), t.parsed_credentials.select(RECORDS), search.identity())


@query(f"SELECT item_id, any_value(last_count) + count(DISTINCT CASE WHEN p.id IS NOT NULL THEN {SOFT} END) AS total, any_value(new_count) + count(DISTINCT CASE WHEN p.id IS NOT NULL THEN {SOFT} END) AS new, greatest(any_value(mark_at), max(created_at)) AS mark FROM {ITEM_SQL} LEFT JOIN parsed_credentials p ON ({HIT}) AND created_at > mark_at WHERE mark_at IS NOT NULL GROUP BY 1")
def watch_incremental(t: Tables) -> DataFrame:
    return watch.sweep_since(watch_items(t), t.parsed_credentials.select(RECORDS), search.identity())


@query(f"""WITH h AS (SELECT item_id, id, created_at, {SOFT} AS i FROM {ITEM_SQL} JOIN parsed_credentials p ON ({HIT}) AND created_at >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY),
 o AS (SELECT *, row_number() OVER (PARTITION BY item_id, i ORDER BY created_at DESC, id DESC) AS r FROM h)
SELECT item_id, id, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY created_at DESC, id DESC) AS k FROM o WHERE r = 1) WHERE k <= 5""")
def watch_hits(t: Tables) -> DataFrame:
    return watch.samples(watch_items(t), t.parsed_credentials.select(RECORDS), search.identity(), NOW).select("item_id", "id", "rank")


@query(f"""WITH h AS (SELECT item_id, id, created_at, {SOFT} AS i FROM {ITEM_SQL} JOIN parsed_credentials p ON ({HIT}) AND created_at > TIMESTAMP '2017-03-20' AND created_at <= TIMESTAMP '{NOW}'),
 c AS (SELECT item_id, count(DISTINCT i) AS new FROM h GROUP BY 1), o AS (SELECT *, row_number() OVER (PARTITION BY item_id, i ORDER BY created_at DESC, id DESC) AS r FROM h WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY),
 s AS (SELECT item_id, id, row_number() OVER (PARTITION BY item_id ORDER BY created_at DESC, id DESC) AS rank FROM o WHERE r = 1)
SELECT c.item_id, new, s.id, s.rank FROM c LEFT JOIN s ON s.item_id = c.item_id AND s.rank <= 5""")
def watch_alerts(t: Tables) -> DataFrame:
    """A first run that only sets the marks, then one that tells of what came since."""
    alerts, records = watch.Alerts(t.spark), t.parsed_credentials.select(RECORDS)
    alerts.run(watch_items(t), records, search.identity(), "2017-03-20 00:00:00")
    return alerts.run(watch_items(t), records, search.identity(), NOW)


@query(f"SELECT coalesce(sum(new_count), 0) AS badge FROM {ITEM_SQL} WHERE mark_at IS NOT NULL")
def watch_badge(t: Tables) -> DataFrame:
    return watch_items(t).filter("last_checked_at is not null").agg(F.coalesce(F.sum("new_count"), F.lit(0)).alias("badge"))


# -- work lists ------------------------------------------------------------------------
@query("""SELECT * FROM (SELECT 'download' AS kind, l_orderkey AS key, l_linenumber AS line, l_shipdate AS shipped FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 45 ORDER BY shipped DESC, key, line LIMIT 20)
UNION ALL SELECT * FROM (SELECT 'job', l_orderkey, l_linenumber, l_shipdate FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal < 0 ORDER BY l_shipdate DESC, l_orderkey, l_linenumber LIMIT 20)""")
def recent_failures(t: Tables) -> DataFrame:
    def some(kind: str, dim: DataFrame, on) -> DataFrame:
        return t.lineitem.join(dim, on).select(F.lit(kind).alias("kind"), F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("shipped")).orderBy(F.desc("shipped"), "key", "line").limit(20)

    downloads = some("download", t.part.filter("p_size > 45").select("p_partkey"), F.col("p_partkey") == F.col("l_partkey"))
    return downloads.unionByName(some("job", t.supplier.filter("s_acctbal < 0").select("s_suppkey"), F.col("s_suppkey") == F.col("l_suppkey")))


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) FILTER (o_orderstatus = 'P') AS pending, count(*) FILTER (o_orderstatus = 'O') AS open FROM orders")
def triage_summary(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.agg(F.count_if(s == "F").alias("failed"), F.count_if(s == "P").alias("pending"), F.count_if(s == "O").alias("open"))


@query(f"""SELECT k AS o_orderkey, status FROM (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' AND coalesce(n, 0) <= 3 THEN 'P' WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1997-01-01' - INTERVAL 24 HOUR THEN 'P' ELSE o_orderstatus END AS status
 FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)""")
def retry_failed(t: Tables) -> DataFrame:
    """What a restart makes of the work at hand: failed work with tries left waits again, and so does what has been under way for too long."""
    tries = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    work = t.orders.join(tries, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    states = restart_states(F.col("o_orderstatus"), F.coalesce("n", F.lit(0)), F.col("o_orderdate"), "1997-01-01 00:00:00", 3, 24)
    return work.select("o_orderkey", states.alias("status"))


def restart_states(status: Column, tries: Column, since: Column, now: str, most: int, hours: int) -> Column:
    """Status columns are the checkpoint: the state from which each piece of work (F failed, O under way, P waiting) goes on."""
    stuck = since < F.lit(now).cast("timestamp") - F.expr(f"interval {hours} hours")
    return F.when((status == "F") & (tries <= most), "P").when((status == "O") & stuck, "P").otherwise(status)


@query("""WITH me AS (SELECT * FROM parsed_credentials WHERE id = (SELECT min(id) FROM parsed_credentials WHERE domain IS NOT NULL AND source_archive IS NOT NULL)),
 c AS (SELECT p.id, 0 AS way FROM parsed_credentials p, me WHERE p.domain = me.domain AND p.id <> me.id UNION ALL SELECT p.id, 1 FROM parsed_credentials p, me WHERE p.source_archive = me.source_archive AND p.id <> me.id AND p.domain IS DISTINCT FROM me.domain)
SELECT id, way FROM (SELECT *, row_number() OVER (ORDER BY way, id DESC) AS r FROM c) WHERE r <= 10""")
def related(t: Tables) -> DataFrame:
    """Up to ten others: of the same domain first, then of the same archive."""
    p = t.parsed_credentials.select("id", "domain", "source_archive")
    me = p.filter("domain is not null and source_archive is not null").orderBy("id").limit(1)
    own, domain, archive = (me.select(c).scalar() for c in ("id", "domain", "source_archive"))
    way = F.when(F.col("domain") == domain, 0).when(F.col("source_archive") == archive, 1)
    return p.filter(F.col("id") != own).select("id", way.alias("way")).filter("way is not null").orderBy("way", F.desc("id")).limit(10)


def _modes() -> dict:
    up, down = F.asc, F.desc_nulls_last
    return {"size": [down("p_size"), up("p_retailprice"), up("p_partkey")], "price": [down("p_retailprice"), up("p_partkey")], "brand": [up("p_brand"), up("p_size"), up("p_partkey")], "id": [up("p_partkey")]}


ORDERS = {"size": "p_size DESC NULLS LAST, p_retailprice, p_partkey", "price": "p_retailprice DESC NULLS LAST, p_partkey", "brand": "p_brand, p_size, p_partkey", "id": "p_partkey"}


@query(" UNION ALL ".join(f"SELECT '{m}' AS mode, p_partkey FROM (SELECT p_partkey FROM part ORDER BY {o} LIMIT 30 OFFSET 30)" for m, o in ORDERS.items()))
def multi_mode_sort(t: Tables) -> DataFrame:
    """The second page in each of four orders."""
    return reduce(DataFrame.unionByName, [search.page(t.part, order, 30, 2).select(F.lit(mode).alias("mode"), "p_partkey") for mode, order in _modes().items()])


# -- event time -------------------------------------------------------------------------
@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def tumbling_hourly(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "1 hour").start.alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("SELECT s AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) GROUP BY 1")
def sliding_windows(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "1 hour", "30 minutes").start.alias("start")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w + INTERVAL 6 HOUR > ts THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


@query("SELECT conversation_id, platform_id, is_forwarded FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY platform_timestamp DESC, delivery_id DESC) AS r FROM messages WHERE conversation_id IS NOT NULL) WHERE r = 1")
def latest_message(t: Tables) -> DataFrame:
    w = Window.partitionBy("conversation_id").orderBy(F.desc("platform_timestamp"), F.desc("delivery_id"))
    return t.messages.filter("conversation_id is not null").withColumn("r", F.row_number().over(w)).filter("r = 1").select("conversation_id", "platform_id", "is_forwarded")


@query("SELECT url, username, min(id) AS id, count(*) AS n FROM parsed_credentials GROUP BY url, username, password")
def dedup_triples(t: Tables) -> DataFrame:
    """One row for each (url, username, secret); the secret does not show."""
    return t.parsed_credentials.groupBy("url", "username", "password").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).select("url", "username", "id", "n")


@query(f"SELECT src AS forwarded_from_id, c.title, count(*) AS n, min(ts) AS first FROM {ONCE} m LEFT JOIN channels c ON c.platform_id = src WHERE src IS NOT NULL GROUP BY ALL")
def forwarded_named(t: Tables) -> DataFrame:
    """Forward sources with their names, if known; counted before the names are looked up."""
    n = once(t).filter("src is not null").groupBy(F.col("src").alias("forwarded_from_id")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"))
    c = t.channels.select(F.col("platform_id").alias("forwarded_from_id"), "title")
    return n.join(c, "forwarded_from_id", "left").select("forwarded_from_id", "title", "n", "first")


@query("""SELECT concat_ws(',', '"' || id || '"', '"' || replace(coalesce(url, ''), '"', '""') || '"', '"' || replace(coalesce(domain, ''), '"', '""') || '"', '"' || replace(coalesce(username, ''), '"', '""') || '"', '"' || replace(coalesce(application, ''), '"', '""') || '"') AS line
FROM (SELECT * FROM parsed_credentials WHERE (domain ILIKE 'shop%' OR username ILIKE 'shop%' OR email_domain ILIKE 'shop%') AND (coalesce(regexp_matches(url, '(?i)/(login|auth)'), false) OR coalesce(regexp_matches(application, '(?i)/(login|auth)'), false)) ORDER BY created_at DESC, id DESC LIMIT 50000)""")
def export_records(t: Tables) -> DataFrame:
    """Records by query with a wildcard, then by pattern, newest first up to the export's limit, as lines without a secret."""
    return sinks.export_records(t.parsed_credentials, "shop*", r"/(login|auth)", ("url", "application"), ["id", "url", "domain", "username", "application"])
