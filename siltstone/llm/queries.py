"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.digests import digest_key, keyed
from siltstone.llm import canonical_runs, encoding_em, leakage, seen_runs, segment_index, shared_spans, tokenizer
from siltstone.sources.tables import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return segment_index.repeats(table(spark, d, "parsed_credentials")).select("id")


def p3_latest_batch(spark: SparkSession, d: str) -> DataFrame:
    """The index kept up: all batches but the last are history, the last is looked up and appended."""
    rows = segment_index.prepared(table(spark, d, "parsed_credentials"))
    last = rows.agg(F.max("batch")).first()[0]
    index = segment_index.SegmentIndex(spark)
    index.add(rows.filter(F.col("batch") < last))
    return index.add(rows.filter(F.col("batch") == last))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return seen_runs.seen_before(table(spark, d, "parsed_credentials")).select("id")


def p4_rate(spark: SparkSession, d: str) -> DataFrame:
    return seen_runs.error_rate(table(spark, d, "parsed_credentials"))


def _garbled(spark: SparkSession, d: str) -> DataFrame:
    credentials = table(spark, d, "parsed_credentials"), "parsed_credentials", ("username", "password"), "source_conversation_id"
    sheets = table(spark, d, "system_info"), "system_info", ("hostname",), "stealer_type"
    return encoding_em.garbled([credentials, sheets])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d).select("record_table", "record_id", "field")


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    """Restored texts; of the password only a keyed digest and whether it could be restored whole."""
    shown = F.when(F.col("field") == "password", keyed(F.col("restored"), digest_key(spark))).otherwise(F.col("restored"))
    return _garbled(spark, d).select("record_table", "record_id", "field", shown.alias("restored"), "complete")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = canonical_runs.scan_runs(table(spark, d, "parsed_credentials"), ("url", "username"), "password")
    return rows.filter("differs").select("first_id", "id")


def p7_copies(spark: SparkSession, d: str) -> DataFrame:
    """One row for each record, with how many rows it has."""
    return canonical_runs.scan_runs(table(spark, d, "parsed_credentials"), ("url", "username"), "password", runs=True)[1]


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_table(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "benchmark_items")).select("doc_id", "item_id")


def p9_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every document, leaked spans cut out of its text."""
    return leakage.without_leaks(table(spark, d, "documents"), table(spark, d, "benchmark_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.sharing_pairs(table(spark, d, "documents"))


def p10_share(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.shared_share(table(spark, d, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_latest_batch, p4_found, p4_rate, p5_found, p5_restored, p7_found, p7_copies, p8_ids, p9_found, p9_cleaned, p10_found, p10_share)}


_CANON = r"""SELECT id, url, username, coalesce(password, '') AS pw,
 array_to_string(list_sort(list_filter(string_split_regex(lower(coalesce(url, '') || ' ' || coalesce(username, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')), ' ') AS words
 FROM parsed_credentials"""

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": "SELECT id FROM (SELECT id, min(id) OVER (PARTITION BY credential_hash) AS first_id FROM parsed_credentials WHERE credential_hash IS NOT NULL) WHERE id > first_id",
        "p4_rate": """WITH b AS (SELECT min(id) AS low, (max(id) - min(id) + 4) // 4 AS width FROM parsed_credentials),
 f AS (SELECT DISTINCT (id - low) // width AS part, credential_hash AS k FROM parsed_credentials, b WHERE credential_hash IS NOT NULL)
SELECT count(*) AS probed, count(*) - count(DISTINCT k) AS hash_hits, count(*) - count(DISTINCT k) AS confirmed, CAST(0 AS DOUBLE) AS wrong_by_hash, CAST(0 AS DOUBLE) AS wrong_after_check FROM f""",
        "p7_found": f"""WITH c AS ({_CANON}), f AS (SELECT *, first_value(id) OVER w AS first_id, first_value(url) OVER w AS u, first_value(username) OVER w AS n
 FROM c WINDOW w AS (PARTITION BY pw, words ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT first_id, id FROM f WHERE id <> first_id AND (url IS DISTINCT FROM u OR username IS DISTINCT FROM n)""",
        "p7_copies": f"WITH c AS ({_CANON}) SELECT min(id) AS first_id, count(*) AS copies FROM c GROUP BY pw, words",
        "p9_found": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark_items),
 dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g FROM d WHERE len(w) >= 13),
 bg AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g FROM b WHERE len(w) >= 13)
SELECT DISTINCT doc_id, item_id FROM dg JOIN bg USING (g)""",
    }
