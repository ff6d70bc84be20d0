"""Watch lists: saved queries that are counted against the records.

An item has a query, a match type (any, domain, user, url) and marks of what
was counted last.  "any" looks at domain, username, url and email_domain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.operators.search import contains_many
from siltstone.session import Versioned, materialise

BY_TYPE = {"domain": ("domain",), "user": ("username",), "url": ("url",), "any": ("domain", "username", "url", "email_domain")}


def hits(items: DataFrame, records: DataFrame) -> DataFrame:
    """Records by item: each searched column of a record is read once, however many items there are."""
    known = items.withColumn("match_type", F.when(F.col("match_type").isin(*BY_TYPE), F.col("match_type")).otherwise("any"))
    columns = reduce(lambda out, kind: out.when(F.col("match_type") == kind, F.array(*[F.lit(c) for c in BY_TYPE[kind]])), list(BY_TYPE)[1:], F.when(F.col("match_type") == next(iter(BY_TYPE)), F.array(*[F.lit(c) for c in BY_TYPE[next(iter(BY_TYPE))]])))
    needles = known.select("item_id", "query", F.explode(columns).alias("_column"))
    searched = sorted({c for names in BY_TYPE.values() for c in names})
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_text")) for c in searched]))
    flat = records.select("id", cells.alias("_c")).select("id", "_c.*").filter("_text is not null")
    pairs = contains_many(flat, ["id"], "_text", needles, "item_id", "query", ["_column"]).distinct()
    return records.join(pairs, "id").join(known, "item_id")


def sweep(items: DataFrame, records: DataFrame, identity: Column) -> DataFrame:
    """Full sweep: count all, report what exceeds the last count, remember the count."""
    n = hits(items, records).groupBy("item_id").agg(F.count_distinct(identity).alias("total"))
    total = F.coalesce("total", F.lit(0))
    return items.join(n, "item_id", "left").select("item_id", total.alias("total"), F.greatest(F.lit(0), total - F.col("last_count")).cast("long").alias("new"))


def sweep_since(items: DataFrame, records: DataFrame, identity: Column, time: str = "created_at") -> DataFrame:
    """Incremental sweep: records after each item's mark are added to both of its counts.

    Items never checked are left out; the mark moves to the last record seen.
    """
    marked = items.filter(F.col("last_checked_at").isNotNull())
    fresh = hits(marked, records).filter(F.col(time) > F.col("last_checked_at"))
    n = fresh.groupBy("item_id").agg(F.count_distinct(identity).alias("delta"), F.max(time).alias("seen"))
    delta = F.coalesce("delta", F.lit(0))
    return marked.join(n, "item_id", "left").select("item_id", (F.col("last_count") + delta).alias("total"), (F.col("new_count") + delta).alias("new"), F.greatest("last_checked_at", "seen").alias("mark"))


def samples(items: DataFrame, records: DataFrame, identity: Column, now: str, n: int = 5, days: int = 7, time: str = "created_at") -> DataFrame:
    """Up to n recent hits of each item, one for each identity."""
    recent = hits(items, records.filter(F.col(time) >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")))
    one = recent.withColumn("_i", identity).withColumn("_r", F.row_number().over(Window.partitionBy("item_id", "_i").orderBy(F.desc(time), F.desc("id")))).filter("_r = 1")
    pick = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc(time), F.desc("id")))
    return one.withColumn("rank", pick).filter(F.col("rank") <= n).drop("_i", "_r")


class Alerts:
    """What each item has told already, kept as a table of versions in the shared folder.

    An item's first run only sets its mark; later runs tell of the hits since.  A
    version appears by one rename, so a run that dies tells the same again.
    """

    SCHEMA = "item_id long, mark timestamp, told long"

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.state = Versioned(spark, "alerts", root)

    def marks(self) -> DataFrame:
        return self.state.read(self.SCHEMA)

    def run(self, items: DataFrame, records: DataFrame, identity: Column, now: str, n: int = 5, days: int = 7, time: str = "created_at") -> DataFrame:
        """(item_id, new, id, rank): up to ``n`` of the latest new hits of each item that has any.

        ``new`` counts all hits after the mark by identity; samples are from the last ``days`` days.
        """
        at = F.lit(now).cast("timestamp")
        marked = items.join(self.marks(), "item_id", "left")
        since = hits(marked.filter("mark is not null"), records).filter((F.col(time) > F.col("mark")) & (F.col(time) <= at))
        counted = since.groupBy("item_id").agg(F.count_distinct(identity).alias("new"))
        recent = since.filter(F.col(time) >= at - F.expr(f"interval {days} days")).withColumn("_i", identity)
        one = recent.withColumn("_r", F.row_number().over(Window.partitionBy("item_id", "_i").orderBy(F.desc(time), F.desc("id")))).filter("_r = 1")
        picked = one.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc(time), F.desc("id")))).filter(F.col("rank") <= n)
        out = materialise(counted.join(picked.select("item_id", "id", "rank"), "item_id", "left").select("item_id", "new", "id", "rank"), "alerts")
        told = out.groupBy("item_id").agg(F.max("new").alias("new"))
        self.state.write(marked.join(told, "item_id", "left").select("item_id", at.alias("mark"), (F.coalesce("told", F.lit(0)) + F.coalesce("new", F.lit(0))).alias("told")))
        return out
