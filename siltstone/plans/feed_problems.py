"""Queries of the general data problems of a message-and-record feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import delivery, heavy_keys, repair_parse
from siltstone.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    store = delivery.ingest_in_steps(table(spark, d, "messages").select("delivery_id", "batch_id", "delivered_at", "conversation_id", "platform_id", "edit_date"))
    return store.rows().filter("copies > 1").select("conversation_id", "platform_id")


def p1_winners(spark: SparkSession, d: str) -> DataFrame:
    """The one copy kept of each message, and how often it was delivered."""
    store = delivery.ingest_in_steps(table(spark, d, "messages"))
    return store.rows().select("conversation_id", "platform_id", "delivery_id", "copies")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return repair_parse.parse_records(table(spark, d, "raw_lines")).filter("status = 'rejected'").select("source_file", "line_number")


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    """Every raw line, loaded with its fields or rejected with its reason."""
    return repair_parse.parse_records(table(spark, d, "raw_lines"))


def _per_key(spark: SparkSession, d: str) -> DataFrame:
    return heavy_keys.counts_and_quantiles(table(spark, d, "parsed_credentials"), ("domain", "email_domain"), "line_number")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _per_key(spark, d).filter(F.col("n") * 50 > F.col("total")).select("field", "key_value")


def p6_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return _per_key(spark, d).select("field", "key_value", "n", "q25", "q50", "q90")


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_winners, p2_found, p2_records, p6_found, p6_quantiles)}


_FIELD = '([^",]*|"(?:[^"]|"")*")'
_VALUE = "CASE WHEN starts_with({0}, '\"') THEN replace({0}[2:-2], '\"\"', '\"') ELSE {0} END"

_KEYS = "SELECT 'domain' AS field, domain AS key_value, line_number AS v FROM parsed_credentials UNION ALL SELECT 'email_domain', email_domain, line_number FROM parsed_credentials"


def oracle_sql() -> dict[str, str]:
    names = ", ".join(f"'f{k}'" for k in range(1, 8))
    form = ",".join([_FIELD] * 7)
    return {
        "p1_found": "SELECT conversation_id, platform_id FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 2",
        "p1_winners": """WITH k AS (SELECT conversation_id, platform_id, delivery_id,
 count(*) OVER (PARTITION BY conversation_id, platform_id) AS copies,
 row_number() OVER (PARTITION BY conversation_id, platform_id ORDER BY edit_date DESC NULLS LAST, delivered_at DESC NULLS LAST, delivery_id DESC) AS r
 FROM messages WHERE conversation_id IS NOT NULL AND platform_id IS NOT NULL)
SELECT conversation_id, platform_id, delivery_id, copies FROM k WHERE r = 1
UNION ALL SELECT conversation_id, platform_id, delivery_id, 1 FROM messages WHERE conversation_id IS NULL OR platform_id IS NULL""",
        "p2_found": f"""WITH m AS (SELECT source_file, line_number, raw_text, regexp_full_match(raw_text, '{form}') AS whole, regexp_extract(raw_text, '^(?:{form})$', [{names}]) AS f FROM raw_lines),
 v AS (SELECT *, {_VALUE.format('f.f1')} AS url, {_VALUE.format('f.f6')} AS job, {_VALUE.format('f.f7')} AS made FROM m)
SELECT source_file, line_number FROM v WHERE NOT coalesce(whole AND regexp_matches(url, '^https?://[^/]') AND regexp_full_match(job, '[0-9]{{1,18}}') AND regexp_matches(job, '[1-9]')
 AND regexp_full_match(made, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]Z') AND try_cast(made[1:10] AS date) IS NOT NULL AND NOT starts_with(made, '0000'), false)""",
        "p6_found": f"WITH k AS ({_KEYS}) SELECT field, key_value FROM k WHERE key_value IS NOT NULL GROUP BY ALL HAVING count(*) * 50 > (SELECT count(*) FROM parsed_credentials)",
        "p6_quantiles": f"""WITH k AS ({_KEYS}), r AS (SELECT field, key_value, v, row_number() OVER (PARTITION BY field, key_value ORDER BY v) AS i,
 count(v) OVER (PARTITION BY field, key_value) AS m, count(*) OVER (PARTITION BY field, key_value) AS n FROM k WHERE key_value IS NOT NULL)
SELECT field, key_value, max(n) AS n, max(v) FILTER (i = greatest((m * 25 + 99) // 100, 1)) AS q25, max(v) FILTER (i = greatest((m * 50 + 99) // 100, 1)) AS q50, max(v) FILTER (i = greatest((m * 90 + 99) // 100, 1)) AS q90 FROM r GROUP BY field, key_value""",
    }
