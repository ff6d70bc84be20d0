"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import files, text
from siltstone.plans.registry import Registry, Tables

registry = Registry()
query = registry.query

def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


SQL_DOMAIN = "split_part(CASE WHEN regexp_matches(url, '^https?://') THEN regexp_replace(url, '^https?://', '') ELSE regexp_replace(url, '^.*?//', '') END, '/', 1)"


@query(f"SELECT id, {SQL_DOMAIN} AS domain FROM parsed_credentials WHERE url IS NOT NULL")
def url_domain(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter("url is not null").select("id", text.url_domain(F.col("url")).alias("domain"))


@query(f"SELECT id, lower(regexp_replace(regexp_replace({SQL_DOMAIN}, '^[^@]*@', ''), '[:?#].*$', '')) AS host FROM parsed_credentials WHERE url IS NOT NULL")
def url_host(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter("url is not null").select("id", text.host(F.col("url")).alias("host"))


@query("SELECT id, CASE WHEN contains(username, '@') THEN lower(split_part(username, '@', 2)) END AS mail FROM parsed_credentials")
def email_domain(t: Tables) -> DataFrame:
    return t.parsed_credentials.select("id", text.email_domain(F.col("username")).alias("mail"))


@query("SELECT id, CASE WHEN regexp_matches(trim(url), '^https?://') THEN trim(url) END AS url FROM parsed_credentials")
def url_validate(t: Tables) -> DataFrame:
    return t.parsed_credentials.select("id", text.valid_url(F.col("url")).alias("url"))


TRIM = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _cut(value: str, pattern: str, test: str) -> str:
    stripped = TRIM.format(f"regexp_replace({value}, '{pattern}', '', 'g')")
    return f"CASE WHEN {test} THEN {stripped} ELSE {value} END"


@query(f"""WITH s AS (SELECT id, {TRIM.format('username')} AS u, {TRIM.format('application')} AS a FROM parsed_credentials), b AS (SELECT id, a, {_cut('u', text.BRACKET_ADVERT, "contains(u, '[')")} AS u FROM s)
SELECT id, {_cut('u', text.ADVERT, "contains(lower(u), 't.me') OR contains(lower(u), 'buy') OR contains(lower(u), 'dm @')")} AS username,
 {_cut('a', text.ADVERT, "contains(lower(a), 't.me') OR contains(lower(a), 'buy') OR contains(lower(a), 'dm @')")} AS application FROM b""")
def clean_text(t: Tables) -> DataFrame:
    return t.parsed_credentials.select("id", text.cleaned(F.col("username"), name=True).alias("username"), text.cleaned(F.col("application")).alias("application"))


@query("SELECT id, substr(url, 1, 24) AS url, substr(source_archive, 1, 10) AS archive FROM parsed_credentials")
def truncate_fields(t: Tables) -> DataFrame:
    return t.parsed_credentials.select("id", text.truncated(F.col("url"), 24).alias("url"), text.truncated(F.col("source_archive"), 10).alias("archive"))


def _placeholder(c: str, words) -> str:
    return f"coalesce((length({c}) <= 15 AND lower({c}) IN ({_in(words)})) OR contains({c}, '<br>') OR contains({c}, '██'), false)"


@query(f"SELECT id, application FROM parsed_credentials WHERE NOT {_placeholder('username', text.NAME_PLACEHOLDERS)} AND NOT {_placeholder('password', text.SECRET_PLACEHOLDERS)}")
def drop_placeholders(t: Tables) -> DataFrame:
    bad = text.is_placeholder(F.col("username")) | text.is_placeholder(F.col("password"), text.SECRET_PLACEHOLDERS)
    return t.parsed_credentials.filter(~bad).select("id", "application")


@query("SELECT id, CASE WHEN substr(credential_hash, 1, 1) >= '8' THEN CAST(CAST(('0x' || substr(credential_hash, 1, 16)) AS UBIGINT) AS HUGEINT) - 18446744073709551616 ELSE CAST(('0x' || substr(credential_hash, 1, 16)) AS UBIGINT) END AS h FROM parsed_credentials WHERE credential_hash IS NOT NULL")
def hash64(t: Tables) -> DataFrame:
    return t.parsed_credentials.filter("credential_hash is not null").select("id", text.hash64(F.col("credential_hash")).alias("h"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL")
def content_hash(t: Tables) -> DataFrame:
    return t.documents.filter("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))


def _case(group: int) -> str:
    rows = []
    for form, numbered in text.SPLIT_FORMS:
        got = f"regexp_extract(filename, '{form}', {group})" if group == 1 or numbered else "NULL"
        rows.append(f"WHEN regexp_matches(filename, '{form}') THEN {got}")
    return "CASE " + " ".join(rows) + " END"


@query(f"SELECT id, {_case(1)} AS base, TRY_CAST({_case(2)} AS INTEGER) AS part, CASE WHEN ({_case(1)}) IS NOT NULL THEN TRY_CAST(nullif(regexp_extract(filename, '(?i)[0-9]+of([0-9]+)', 1), '') AS INTEGER) END AS total FROM file_attachments")
def split_name(t: Tables) -> DataFrame:
    f = F.col("filename")
    return t.file_attachments.select("id", text.split_base(f).alias("base"), text.split_part_number(f).alias("part"), text.split_total(f).alias("total"))


def _hint(group: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(x, '{p}') THEN TRY_CAST(regexp_extract(x, '{p}', {group}) AS INTEGER)" for p in text.PART_HINTS) + " END"


@query(f"SELECT delivery_id, {_hint(1)} AS part, {_hint(2)} AS total FROM (SELECT delivery_id, coalesce(caption, text, '') AS x FROM messages)")
def caption_hint(t: Tables) -> DataFrame:
    x = F.coalesce("caption", "text", F.lit(""))
    return t.messages.select("delivery_id", text.part_hint(x, 1).alias("part"), text.part_hint(x, 2).alias("total"))


def _names(c: str, pattern: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '{pattern}', 1), lambda x: lower(x))"


LISTED = """WITH m AS (SELECT doc_id, {0} AS a, {1} AS b, {2} AS c FROM (SELECT doc_id, {3} AS x FROM documents))
SELECT doc_id, unnest(list_distinct(list_filter(list_concat(a, c), lambda x: NOT list_contains(b, x) AND x NOT IN ({4})))) AS mention FROM m"""
#: Documents with names in them: each source as a mention and as a link.
WITH_NAMES = "coalesce(text, '') || ' @' || source || ' box@' || source || 'x https://t.me/' || source || ' t.me/+' || doc_id"


def _with_names(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" @"), "source", F.lit(" box@"), "source", F.lit("x https://t.me/"), "source", F.lit(" t.me/+"), F.col("doc_id").cast("string")).alias("x"))


@query(LISTED.format(_names("x", f"@({text.HANDLE})"), _names("x", f"[A-Za-z0-9._%+-]@({text.HANDLE})"), _names("x", text.NAME_LINK), WITH_NAMES, _in(text.NO_CHANNELS)))
def mentions(t: Tables) -> DataFrame:
    """Names mentioned in a text or linked from it; a mail host is none."""
    return _with_names(t).select("doc_id", F.explode(F.array_union(text.mentions(F.col("x")), text.linked_names(F.col("x")))).alias("mention"))


@query(f"SELECT doc_id, unnest(list_distinct(regexp_extract_all({WITH_NAMES}, '{text.INVITE_LINK}', 1))) AS invitation FROM documents")
def invitations(t: Tables) -> DataFrame:
    return _with_names(t).select("doc_id", F.explode(text.invitations(F.col("x"))).alias("invitation"))


KEY = f"trim(regexp_replace(lower(translate({{0}}, '{text.LOOKALIKES_FROM}', '{text.LOOKALIKES_TO}')), '[\\s._-]+', ' ', 'g'))"


@query(f"SELECT id, {KEY.format('filename')} AS key FROM file_attachments")
def confusable_key(t: Tables) -> DataFrame:
    """The check's SQL lacks compatibility forms, of which the file names have none; a test has them."""
    return t.file_attachments.select("id", text.group_key(F.col("filename")).alias("key"))


@query("SELECT id, coalesce(nullif(hostname, ''), nullif(username, ''), nullif(hwid, '')) AS label FROM system_info")
def first_label(t: Tables) -> DataFrame:
    m = F.create_map(F.lit("pc"), F.col("hostname"), F.lit("user"), F.col("username"), F.lit("hwid"), F.col("hwid"))
    return t.system_info.select("id", text.first_label(m, ["machine", "pc", "user", "hwid"]).alias("label"))


@query()
def strip_markdown(t: Tables) -> DataFrame:
    """Every text; the check's SQL lacks look-around, so a test compares all of them with an independent reading."""
    return t.documents.select("doc_id", text.without_markdown(F.col("text")).alias("plain"))


@query("SELECT id, CASE WHEN coalesce(length(hwid), 0) = 0 THEN '—' WHEN length(hwid) <= 2 THEN repeat('•', length(hwid)) ELSE hwid[1] || repeat('•', length(hwid) - 2) || hwid[-1] || ' (' || length(hwid) || ' chars)' END AS masked FROM system_info")
def mask(t: Tables) -> DataFrame:
    return t.system_info.select("id", text.masked(F.col("hwid")).alias("masked"))


@query("SELECT p_partkey, format('{:,}', p_partkey * 1000) AS shown, CASE WHEN p_size > 25 THEN format('{:,}', CAST(round_even(p_partkey * 1000.0 / (p_size - 25), 0) AS BIGINT)) || '/s' ELSE '—' END AS rate, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s // 3600 || 'h ' || s % 3600 // 60 || 'm' END AS lasting FROM (SELECT p_partkey, p_size, p_partkey * 37 AS s FROM part)")
def format_values(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.grouped_digits(F.col("p_partkey") * 1000).alias("shown"), text.rate(F.col("p_partkey") * 1000, F.col("p_size") - 25).alias("rate"), text.duration(F.col("p_partkey") * 37).alias("lasting"))


@query("SELECT id, substr(regexp_replace(filename, '[^A-Za-z0-9._-]', '_', 'g'), 1, 200) AS name FROM file_attachments")
def sanitize_filename(t: Tables) -> DataFrame:
    return t.file_attachments.select("id", text.safe_filename(F.col("filename")).alias("name"))


SCORE_INPUT = "(SELECT s_suppkey, 0.3 + 0.1 * (s_nationkey % 8) AS w, least(1.0, abs(s_acctbal) / 10000) AS c, s_nationkey % 4 AS won, s_nationkey % 5 AS lost FROM supplier)"


def _scored(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", (0.3 + 0.1 * (F.col("s_nationkey") % 8)).alias("w"), F.least(F.lit(1.0), F.abs("s_acctbal") / 10000).alias("c"), (F.col("s_nationkey") % 4).alias("won"), (F.col("s_nationkey") % 5).alias("lost"))


@query(f"""WITH a AS (SELECT *, w * c * CASE WHEN won + lost > 0 THEN 0.5 + 0.5 * won / (won + lost) ELSE 1.0 END AS x FROM {SCORE_INPUT}), b AS (SELECT *, CASE WHEN won > 0 THEN least(1.0, x * 1.2) ELSE x END AS y FROM a)
SELECT s_suppkey, round(least(1.0, greatest(0.0, CASE WHEN lost > 2 THEN y * 0.5 ELSE y END)), 6) AS score FROM b""")
def score(t: Tables) -> DataFrame:
    return _scored(t).select("s_suppkey", F.round(text.weighted_score(F.col("w"), F.col("c"), F.col("won"), F.col("lost")), 6).alias("score"))


@query(f"""SELECT s_suppkey, concat_ws('; ', 'rated', CASE WHEN won > 0 THEN 'succeeded ' || won || 'x' END, CASE WHEN lost > 0 THEN 'failed ' || lost || 'x' END,
 CASE WHEN c >= 0.9 THEN 'high confidence' WHEN c >= 0.7 THEN 'medium confidence' WHEN c < 0.5 THEN 'low confidence' END) AS reason FROM {SCORE_INPUT}""")
def explain(t: Tables) -> DataFrame:
    return _scored(t).select("s_suppkey", text.explanation(F.lit("rated"), F.col("won"), F.col("lost"), F.col("c")).alias("reason"))


@query(f"""WITH f AS (SELECT id, lower(coalesce(filename, '')) AS n, coalesce(mime_type, '') AS m, size, regexp_extract(lower(coalesce(filename, '')), '[^.]\\.([^.]*)$', 1) AS e FROM file_attachments)
SELECT id, CASE WHEN e IN ({_in(files.REJECTED_ENDINGS)}) OR m IN ({_in(files.REJECTED_TYPES)}) THEN 'rejected' WHEN regexp_matches(n, '{files.SPLIT}') THEN 'split' WHEN e IN ({_in(files.ARCHIVE_ENDINGS)}) THEN 'archive'
 WHEN e = 'txt' AND regexp_matches(n, '{files.TEXT_NAMES}') THEN 'text' WHEN m IN ({_in(files.ARCHIVE_TYPES)}) THEN 'archive' WHEN m = 'application/octet-stream' AND size > 1048576 AND size < 524288000 THEN 'untyped' ELSE 'other' END AS class FROM f""")
def classify_file(t: Tables) -> DataFrame:
    return t.file_attachments.select("id", files.attachment_class(F.col("filename"), F.col("mime_type"), F.col("size")).alias("class"))


@query(f"SELECT id, CASE WHEN regexp_matches(lower(filename), '{files.SPLIT}') THEN 1 WHEN regexp_matches(lower(filename), '\\.(zip|rar|7z)$') THEN 0 ELSE 2 END AS priority FROM file_attachments")
def priority(t: Tables) -> DataFrame:
    return t.file_attachments.select("id", files.download_priority(F.col("filename")).alias("priority"))


def _rules(column: str, k: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{r[k]}') THEN '{r[0]}'" for r in files.FAMILY_RULES) + " END"


@query(f"SELECT doc_id, coalesce(nullif(regexp_extract(text, '(?im)^type\\s*[:=]\\s*([^\\n]{{1,50}})$', 1), ''), {_rules('lower(source)', 1)}, {_rules('text', 2)}) AS family FROM documents")
def family_label(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", files.family(F.col("source"), F.col("text")).alias("family"))


@query("SELECT id, regexp_extract(source_file, '[^/]+$') AS base FROM parsed_credentials WHERE regexp_matches(regexp_extract(source_file, '[^/]+$'), '(?i)^(mirror|note|log)')")
def file_class(t: Tables) -> DataFrame:
    base = F.regexp_extract("source_file", "[^/]+$", 0)
    return t.parsed_credentials.filter(base.rlike("(?i)^(mirror|note|log)")).select("id", base.alias("base"))


@query("SELECT id, array_to_string(list_filter([CASE WHEN contains(lower(domain), 'shop') THEN 'domain' END, CASE WHEN contains(lower(username), 'shop') THEN 'username' END, CASE WHEN contains(lower(url), 'shop') THEN 'url' END], lambda x: x IS NOT NULL), ',') AS fields FROM parsed_credentials WHERE contains(lower(domain), 'shop') OR contains(lower(username), 'shop') OR contains(lower(url), 'shop')")
def matched_field_list(t: Tables) -> DataFrame:
    m = text.matched_fields("shop", ["domain", "username", "url"])
    return t.parsed_credentials.select("id", F.array_join(m, ",").alias("fields")).filter("fields <> ''")


@query("SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month, CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(ts)) AS BIGINT) AS age_s, json_extract_string(props, '$.k') AS k FROM events")
def buckets_and_ages(t: Tables) -> DataFrame:
    age = F.unix_timestamp(F.lit("2024-01-31").cast("timestamp")) - F.unix_timestamp("ts")
    return t.events.select("event_id", F.to_date("ts").alias("day"), F.date_format("ts", "yyyy-MM").alias("month"), age.alias("age_s"), F.get_json_object("props", "$.k").alias("k"))


@query("SELECT source_conversation_id, len(list(DISTINCT stealer_type)) AS types FROM parsed_credentials WHERE stealer_type IS NOT NULL GROUP BY 1")
def json_list_length(t: Tables) -> DataFrame:
    """Short lists kept as JSON text, and their lengths read back."""
    lists = t.parsed_credentials.filter("stealer_type is not null").groupBy("source_conversation_id").agg(F.to_json(F.collect_set("stealer_type")).alias("j"))
    return lists.select("source_conversation_id", F.json_array_length("j").cast("long").alias("types"))
