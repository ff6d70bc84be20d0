"""Record parsing, grouping, exports, streams and the pipeline over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import text
from siltstone.operators import grouping, records, search
from siltstone.plans import feed_problems, function_queries, pipeline
from siltstone.plans.registry import Registry, Tables
from siltstone.plans.search_queries import HIT, ITEM_SQL, RECORDS, SOFT, watch_items
from siltstone.plans.stats_queries import once
from siltstone.session import materialise, workspace
from siltstone.sources import files, sinks
from siltstone.streaming import feeds

registry = Registry()
query = registry.query


@query(r"""WITH b AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '(?m)^(?:[ \t]*|---+[ \t]*|===+[ \t]*|_{3,}[ \t]*)$', chr(1), 'g'), chr(1)), lambda x: trim(x, chr(10))), lambda x: x <> '')) AS block FROM documents WHERE doc_kind = 'system_sheet')
SELECT doc_id, nullif(trim(regexp_extract(block, '(?m)^[ \t]*Machine\s*[:=]\s*(\S.*)$', 1)), '') AS hostname, nullif(trim(regexp_extract(block, '(?m)^[ \t]*Build\s*[:=]\s*(\S.*)$', 1)), '') AS build FROM b WHERE regexp_matches(block, '(?m)^[ \t]*Machine\s*[:=]\s*\S')""")
def parse_sheet(t: Tables) -> DataFrame:
    """Labelled sheets, one for each block of a text, whatever its line ends."""
    return records.sheets(t.documents.filter("doc_kind = 'system_sheet'"), "doc_id", "text").filter("hostname is not null").select("doc_id", "hostname", "build")


_TRIPLES = (r"^(https?://[^\s:]+(?::[0-9]+)?(?:/[^\s:]*)?):([^:]+):(.+)$", r"^(https?://[^\s|]+)\s*[|]\s*([^|]+?)\s*[|](.+)$", r"^(https?://[^\s;]+)\s*;\s*([^;]+?)\s*;(.+)$")


def _field(k: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(x, '{form}') THEN trim(regexp_extract(x, '{form}', {k}))" for form in _TRIPLES) + " END"


@query(f"""WITH l AS (SELECT id, concat('https://', domain, '/a', mark, application, mark, source_file, mark, line_number) AS x FROM (SELECT *, CASE id % 3 WHEN 0 THEN ':' WHEN 1 THEN ' | ' ELSE ';' END AS mark FROM parsed_credentials))
SELECT id, {_field(1)} AS url, {_field(2)} AS username, length({_field(3)}) AS last_length FROM l WHERE {_field(1)} IS NOT NULL""")
def parse_delimited(t: Tables) -> DataFrame:
    """Every row written as a line in one of the three forms; a line that lacks a field is no record."""
    mark = F.when(F.col("id") % 3 == 0, ":").when(F.col("id") % 3 == 1, " | ").otherwise(";")
    lines = t.parsed_credentials.select("id", F.concat_ws("", F.lit("https://"), "domain", F.lit("/a"), mark, "application", mark, "source_file", mark, F.col("line_number").cast("string")).alias("x"))
    return records.delimited(lines, ["id"], "x").select("id", "url", "username", "last_length")


@query("SELECT o_orderkey, CAST(0 AS INTEGER) AS record_no, 'https://shop.test/' || o_orderkey AS url, 'customer' || o_custkey AS username, 'App' AS application, o_orderpriority AS profile FROM orders")
def parse_blocks(t: Tables) -> DataFrame:
    """Orders rendered as labelled blocks, values on the next line, and read back."""
    o = t.orders.select("o_orderkey", F.concat(F.lit("[App="), "o_orderpriority", F.lit("]\nURL: https://shop.test/"), F.col("o_orderkey").cast("string"), F.lit("\nUser:\ncustomer"), F.col("o_custkey").cast("string"), F.lit("\nPassword = "), F.col("o_totalprice").cast("string"), F.lit("\n---\n")).alias("x"))
    return records.parse_texts(o, "o_orderkey", "x").drop("digest")


@query("SELECT o_orderkey, 'customer' || o_custkey AS username FROM orders")
def parse_chunks(t: Tables) -> DataFrame:
    """The orders of a customer as one text, cut into chunks and parsed chunk by chunk: nothing is lost."""
    block = F.concat(F.lit("URL: https://shop.test/"), F.col("o_orderkey").cast("string"), F.lit("\nUser: customer"), F.col("o_custkey").cast("string"), F.lit("\nPassword: "), F.col("o_totalprice").cast("string"), F.lit("\n\n"))
    whole = t.orders.groupBy("o_custkey").agg(F.array_join(F.collect_list(block), "").alias("x"))
    chunks = files.line_chunks(whole, "o_custkey", "x", 10)
    return records.parse_texts(chunks, "o_custkey", "chunk").select(F.regexp_extract("url", "[0-9]+$", 0).cast("long").alias("o_orderkey"), "username")


PART = r"regexp_extract(lower(filename), '\.part0*([0-9]+)\.(?:zip|rar|7z)$|\.(?:7z|zip)\.0*([0-9]+)$', {0})"


@query(f"SELECT id FROM file_attachments WHERE filename IS NOT NULL AND coalesce(nullif({PART.format(1)}, ''), nullif({PART.format(2)}, ''), '1') = '1'")
def first_part_files(t: Tables) -> DataFrame:
    """Of split sets only the first part, by the names that attachments have."""
    listing = t.file_attachments.filter("filename is not null").select("id", F.concat(F.lit("/in/"), F.regexp_replace("filename", "/", "_")).alias("path"))
    return files.first_parts(listing).select("id")


_F = f"(SELECT id, conversation_id AS c, part, total, CASE WHEN part IS NULL THEN 'single:' || id ELSE 'set:' || coalesce(conversation_id, -1) || ':' || {function_queries.KEY.format('base')} END AS grp FROM (SELECT s.*, a.conversation_id FROM ({function_queries.registry.oracle_sql()['split_name']}) s JOIN file_attachments a USING (id)) WHERE base IS NOT NULL)"


@query(f"""SELECT grp AS "group", min(c) AS conversation, count(*) AS n, coalesce(max(total), max(part) - min(part) + 1, 1) AS expected, coalesce(max(part) - min(part) + 1 > count(DISTINCT part), false) OR coalesce(min(part) > 1, false) AS gap FROM {_F} GROUP BY grp""")
def group_parts(t: Tables) -> DataFrame:
    return grouping.group_parts(t.file_attachments)


@query("SELECT c_mktsegment, count(*) AS orders, sum(o_totalprice) AS total FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def sql_views(t: Tables) -> DataFrame:
    """The tables as views of the session, and a query in SQL over them."""
    for name in ("orders", "customer"):
        getattr(t, name).createOrReplaceTempView(f"siltstone_{name}")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS orders, sum(o_totalprice) AS total FROM siltstone_orders JOIN siltstone_customer ON c_custkey = o_custkey GROUP BY 1")


@query("SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1")
def written_table(t: Tables) -> DataFrame:
    """An intermediate result written to the shared folder and read back."""
    return materialise(t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")), "written-table")


@query("SELECT count(*) AS rows, CAST(1 AS BIGINT) AS finished FROM events")
def progress_log(t: Tables) -> DataFrame:
    """What the listener of streams has told of one run: the rows of all micro-batches, and its end."""
    log, out = feeds.ProgressLog(), feeds.Appender(t.spark, "progress")
    t.spark.streams.addListener(log)
    try:
        feeds.run(_stream(t, "events").select("event_id"), out.write, "progress")
        t.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        t.spark.streams.removeListener(log)
    return log.table(t.spark).agg(F.sum("rows").alias("rows"), F.count_if(F.col("state") == "finished").alias("finished"))


@query("SELECT id, CASE WHEN length(domain) <= 2 THEN repeat('•', length(domain)) ELSE domain[1] || repeat('•', length(domain) - 2) || domain[-1] || ' (' || length(domain) || ' chars)' END AS domain FROM parsed_credentials WHERE domain ILIKE '%shop%'")
def stream_notices(t: Tables) -> DataFrame:
    """Rows fit to be sent as they arrive: masked, and without secret columns."""
    s = feeds.notices(_stream(t, "parsed_credentials").filter(F.col("domain").ilike("%shop%")).select("id", "domain", "password"), ["domain"])
    out = feeds.Appender(t.spark, "notices")
    feeds.run(s, out.write, "notices")
    return out.read(s.schema)


@query("SELECT id, row_number() OVER (PARTITION BY conversation_id, message_id ORDER BY filename NULLS FIRST, id) AS part_no FROM file_attachments")
def number_parts(t: Tables) -> DataFrame:
    a = t.file_attachments.withColumns({"g": F.to_json(F.struct("conversation_id", "message_id")), "o": F.struct("filename", "id")})
    return grouping.numbered(a, "g", "o").select("id", "part_no")


@query("""SELECT concat_ws(',', '"' || id || '"', '"' || replace(coalesce(filename, ''), '"', '""') || '"', '"' || replace(coalesce(mime_type, ''), '"', '""') || '"') AS line FROM file_attachments""")
def export_csv(t: Tables) -> DataFrame:
    return sinks.csv_lines(t.file_attachments.select("id", "filename", "mime_type"))


#: Result sets of the export, with the order of their rows.
SETS = {
    "channels": ("channels", ("platform_id", "title", "username", "conversation_type", "is_member"), "platform_id"),
    "messages": ("messages", ("delivery_id", "conversation_id", "platform_id", "post_author"), "delivery_id"),
    "attachments": ("file_attachments", ("id", "conversation_id", "message_id", "filename", "mime_type"), "id"),
    "records": ("parsed_credentials", ("id", "domain", "email_domain", "application", "source_file", "line_number"), "id"),
    "systems": ("system_info", ("id", "extraction_job_id", "country", "os"), "id"),
    "documents": ("documents", ("doc_id", "lang", "source", "n_chars"), "doc_id"),
    "items": ("benchmark_items", ("item_id", "suite", "n_words"), "item_id"),
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS set_name, (SELECT count(*) FROM {table}) AS found, {sinks.SET_LIMITS[name]} AS row_limit, line FROM (SELECT to_json({{{', '.join(f'{chr(39)}{c}{chr(39)}: {c}' for c in cs)}}}) AS line FROM {table} ORDER BY {o} DESC LIMIT {sinks.SET_LIMITS[name]})" for name, (table, cs, o) in SETS.items()))
def export_json(t: Tables) -> DataFrame:
    """Seven result sets as JSON lines, each newest first up to its limit, which goes with it."""
    return sinks.export_sets({name: getattr(t, table).select(*cs) for name, (table, cs, _) in SETS.items()}, {name: [F.desc(o)] for name, (_, _, o) in SETS.items()})


@query("SELECT '| ' || concat_ws(' | ', CAST(platform_id AS VARCHAR), replace(replace(coalesce(title, ''), '|', '\\|'), chr(10), '<br>'), replace(coalesce(username, ''), '|', '\\|')) || ' |' AS line FROM channels")
def export_md(t: Tables) -> DataFrame:
    return sinks.markdown_lines(t.channels.select("platform_id", "title", "username"))


TOTALS = (("channels", "channels"), ("messages", "messages"), ("attachments", "file_attachments"), ("records", "parsed_credentials"))


@query(" UNION ALL ".join(f"SELECT 'total' AS section, CAST({i} AS BIGINT) AS place, '{name}' AS title, (SELECT count(*) FROM {table}) AS amount" for i, (name, table) in enumerate(TOTALS, 1)) + """
 UNION ALL SELECT 'channel', row_number() OVER (ORDER BY member_count DESC NULLS LAST, platform_id), coalesce(title, '(no title)'), member_count FROM channels
 UNION ALL SELECT * FROM (SELECT 'candidate', row_number() OVER (ORDER BY n DESC, src), CAST(src AS VARCHAR), n FROM (SELECT forwarded_from_id AS src, count(DISTINCT (conversation_id, platform_id)) AS n FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL AND forwarded_from_id IS NOT NULL AND forwarded_from_id NOT IN (SELECT platform_id FROM channels) GROUP BY 1) ORDER BY n DESC, src LIMIT 100)""")
def channel_report(t: Tables) -> DataFrame:
    """Totals, all channels by members (unknown last), and the hundred unknown channels that are forwarded most."""
    out = None
    for i, (name, table) in enumerate(TOTALS, 1):
        one = getattr(t, table).agg(F.count(F.lit(1)).alias("amount")).select(F.lit("total").alias("section"), F.lit(i).cast("long").alias("place"), F.lit(name).alias("title"), "amount")
        out = one if out is None else out.unionByName(one)
    # the channels of a registry: one row each, all of them on the report
    ranked = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("member_count"), "platform_id")).cast("long")
    channels = t.channels.select(F.lit("channel").alias("section"), ranked.alias("place"), F.coalesce("title", F.lit("(no title)")).alias("title"), F.col("member_count").cast("long").alias("amount"))
    unknown = once(t).filter("src is not null").join(t.channels.select(F.col("platform_id").alias("src")), "src", "left_anti").groupBy("src").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "src").limit(100)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "src")).cast("long")
    candidates = unknown.select(F.lit("candidate").alias("section"), place.alias("place"), F.col("src").cast("string").alias("title"), F.col("n").alias("amount"))
    return out.unionByName(channels).unionByName(candidates)


@query("SELECT count(*) AS first_load, CAST(0 AS BIGINT) AS second_load FROM orders")
def folder_load(t: Tables) -> DataFrame:
    """Orders written as text files of labelled blocks, loaded as a folder, and loaded again: then nothing is new."""
    at = workspace(t.spark, "folder")
    block = F.concat(F.lit("URL: https://shop.test/"), F.col("o_orderkey").cast("string"), F.lit("\nUser: customer"), F.col("o_custkey").cast("string"), F.lit("\nPassword: "), F.col("o_totalprice").cast("string"), F.lit("\n"))
    t.orders.select(block.alias("value")).write.text(f"{at}/in")
    loads = [files.load_folder(t.spark, f"{at}/in", f"{at}/records") for _ in range(2)]
    return t.spark.createDataFrame([tuple(loads)], "first_load long, second_load long")


@query("SELECT max(id) AS mark, count(*) AS rows, CAST(2 AS BIGINT) AS scans FROM parsed_credentials")
def scan_marks(t: Tables) -> DataFrame:
    """Two scans behind a mark, the first of half the rows, a third that fails and a fourth that finds nothing new."""
    out, marks = feeds.Appender(t.spark, "scan-marks"), feeds.Marks(t.spark)
    p = t.parsed_credentials.select("id")
    half = p.agg(F.max("id")).first()[0] // 2

    def broken(rows: DataFrame) -> None:
        raise RuntimeError("no work is done")

    for k, rows in enumerate((p.filter(F.col("id") <= half), p)):
        try:
            marks.scan(rows, "records", "id", broken)
        except RuntimeError:
            pass
        marks.scan(rows, "records", "id", lambda fresh, k=k: out.write(fresh, k))
    marks.scan(p, "records", "id", broken)
    done = out.read(p.schema).agg(F.count(F.lit(1)).alias("rows"))
    return done.select(F.lit(marks.get("records")).cast("long").alias("mark"), "rows", F.lit(2).cast("long").alias("scans"))


# -- streams, each over the whole table ----------------------------------------------
def _stream(t: Tables, name: str) -> DataFrame:
    schema = getattr(t, name).schema
    plain = t.spark.read.parquet(f"{t.folder}/{name}.parquet").schema
    s = feeds.file_stream(t.spark, f"{t.folder}/{name}.parquet", plain)
    return s.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in schema if f.dataType != plain[f.name].dataType})


@query("SELECT conversation_id, platform_id, count(*) AS n FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL GROUP BY ALL")
def stream_ingest(t: Tables) -> DataFrame:
    """Append-only ingest by files; the checkpoint is the cursor."""
    s = _stream(t, "messages").filter("conversation_id is not null and platform_id is not null").select("conversation_id", "platform_id", "delivery_id")
    out = feeds.Appender(t.spark, "stream-ingest")
    feeds.run(s, out.write, "stream-ingest")
    return out.read(s.schema).groupBy("conversation_id", "platform_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT event_id FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    s = feeds.deduplicated(_stream(t, "events").select("event_id", "ts"), ["event_id"], "ts")
    out = feeds.Appender(t.spark, "stream-dedup")
    feeds.run(s, out.write, "stream-dedup")
    return out.read(s.schema).select("event_id")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY 1")
def stream_hourly(t: Tables) -> DataFrame:
    s = feeds.tumbling(_stream(t, "events").select("ts"), "ts", "1 hour")
    out = feeds.LatestTable(t.spark, "start", "n")
    feeds.run(s, out.write, "stream-hourly", "update")
    return out.read()


@query("SELECT h, f.us AS first_us, f.c AS conversation_id, duplicates FROM (SELECT h, arg_min({'us': us, 'c': c}, (us IS NULL, us, c IS NULL, c)) AS f, count(*) - 1 AS duplicates FROM (SELECT sha256(text) AS h, epoch_us(platform_timestamp) AS us, conversation_id AS c FROM documents WHERE text IS NOT NULL) GROUP BY 1)")
def stream_first_seen(t: Tables) -> DataFrame:
    """Every text; rows without a time come last, a conversation may be null."""
    s = feeds.first_seen(_stream(t, "documents").withColumn("h", F.sha2("text", 256)), "h", "platform_timestamp", "conversation_id")
    out = feeds.LatestTable(t.spark, "h", "duplicates")
    feeds.run(s, out.write, "stream-first-seen", "update")
    return out.read()


@query(f"SELECT item_id, id FROM {ITEM_SQL} JOIN parsed_credentials p ON ({HIT}) AND created_at > mark_at WHERE mark_at IS NOT NULL")
def stream_watch(t: Tables) -> DataFrame:
    """Hits of every watch item as records arrive; counters and marks are kept beside them."""
    counts = feeds.WatchCounts(watch_items(t), search.identity())
    feeds.run(_stream(t, "parsed_credentials").select(RECORDS), counts.write, "stream-watch")
    return counts.hits.read(StructType.fromDDL("item_id long, id long"))


@query(f"SELECT item_id, any_value(last_count) + count(DISTINCT CASE WHEN p.id IS NOT NULL THEN {SOFT} END) AS total, any_value(new_count) + count(DISTINCT CASE WHEN p.id IS NOT NULL THEN {SOFT} END) AS new FROM {ITEM_SQL} LEFT JOIN parsed_credentials p ON ({HIT}) AND created_at > mark_at AND mark_at IS NOT NULL GROUP BY 1")
def stream_watch_counts(t: Tables) -> DataFrame:
    """The counters of the items after the stream; identities count once a micro-batch, and a single file is one."""
    counts = feeds.WatchCounts(watch_items(t), search.identity())
    feeds.run(_stream(t, "parsed_credentials").select(RECORDS), counts.write, "stream-watch-counts")
    return counts.counts().select("item_id", "total", "new")


_VALID = f"(source_file, line_number) NOT IN (SELECT (source_file, line_number) FROM ({feed_problems.oracle_sql()['p2_found']}))"
_CLASS = function_queries.registry.oracle_sql()["classify_file"]
_CANDIDATES = f"(SELECT a.* FROM file_attachments a JOIN ({_CLASS}) k ON k.id = a.id WHERE k.class IN ('split', 'archive', 'text', 'untyped'))"
_PLANNED = f"(SELECT a.* FROM {_CANDIDATES} a WHERE EXISTS (SELECT 1 FROM messages m WHERE m.conversation_id = a.conversation_id AND m.platform_id = a.message_id) AND a.id IN (SELECT id FROM ({function_queries.registry.oracle_sql()['split_name']}) WHERE base IS NOT NULL))"
_NAMES_IN_TEXT = f"SELECT DISTINCT unnest(list_distinct(list_filter(list_concat(list_transform(regexp_extract_all(text, '@({text.HANDLE})', 1), lambda y: lower(y)), list_transform(regexp_extract_all(text, '{text.NAME_LINK}', 1), lambda y: lower(y))), lambda y: y NOT IN ({', '.join(repr(w) for w in text.NO_CHANNELS)}) AND NOT list_contains(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]@({text.HANDLE})', 1), lambda z: lower(z)), y)))) AS name FROM documents"


@query(f"""WITH made AS (
 SELECT 'ingest' AS stage, (SELECT count(DISTINCT (conversation_id, platform_id)) FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL) + (SELECT count(*) FROM messages WHERE conversation_id IS NULL OR platform_id IS NULL) AS rows
 UNION ALL SELECT 'channel_discover', count(DISTINCT c) FROM (SELECT CAST(platform_id AS VARCHAR) AS c FROM channels WHERE is_member UNION ALL SELECT CAST(forwarded_from_id AS VARCHAR) FROM messages UNION ALL SELECT CAST(conversation_id AS VARCHAR) FROM file_attachments
  UNION ALL SELECT coalesce(CAST(b.id AS VARCHAR), '@' || n.name) FROM ({_NAMES_IN_TEXT}) n LEFT JOIN (SELECT lower(username) AS name, min(platform_id) AS id FROM channels GROUP BY 1) b ON b.name = n.name)
 UNION ALL SELECT 'discover', count(*) FROM file_attachments
 UNION ALL SELECT 'plan', count(*) FROM {_PLANNED}
 UNION ALL SELECT 'acquire', count(*) FROM {_PLANNED}
 UNION ALL SELECT 'enrich', count(*) FROM (SELECT conversation_id, platform_id FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id, platform_id ORDER BY edit_date DESC NULLS LAST, delivered_at DESC NULLS LAST, delivery_id DESC) AS r FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL) w
  WHERE r = 1 AND is_forwarded AND forwarded_from_id IS NOT NULL AND EXISTS (SELECT 1 FROM {_CANDIDATES} a WHERE a.conversation_id = w.conversation_id AND a.message_id = w.platform_id))
 UNION ALL SELECT 'parse', count(DISTINCT raw_text) FROM raw_lines WHERE {_VALID}
 UNION ALL SELECT 'finalise', count(DISTINCT text) FROM documents
 UNION ALL SELECT 'count_records', count(DISTINCT extraction_job_id) FROM parsed_credentials
 UNION ALL SELECT 'prune', count(*) FROM system_info WHERE extraction_job_id IS NULL OR extraction_job_id NOT IN (SELECT extraction_job_id FROM parsed_credentials WHERE extraction_job_id IS NOT NULL))
SELECT stage, 'made' AS state, rows FROM made""")
def pipeline_stages(t: Tables) -> DataFrame:
    """Rows that each stage of the pipeline makes; a stage that fails is told as failed."""
    return pipeline.report(t, pipeline.run_pipeline(t))
