"""Dashboard aggregates: top lists, rates, series, bursts, grouped top-k and pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: Sequence[str], measure: Column, n: int, name: str = "n") -> DataFrame:
    """The n groups with the greatest measure, keys breaking ties.

    orderBy + limit becomes one TakeOrderedAndProject; only n rows leave a task.
    """
    return df.groupBy(*keys).agg(measure.alias(name)).orderBy(F.desc(name), *keys).limit(n)


def since(df: DataFrame, column: str, now: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``now``; 0 means all of them."""
    return df.filter(F.col(column) >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")) if days else df


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, cut not rounded, 0 where there is nothing to divide by."""
    return F.when(whole > 0, F.floor(part * 100 / whole)).otherwise(0).cast("long")


def late_lookup(top: DataFrame, dim: DataFrame, on: Column) -> DataFrame:
    """Names for a short list: the list is limited first and sent to the dimension, whose few hits are then sent back.

    ``on`` names columns of either side once each; a key is unique in the
    dimension, so the hits are at most as many as the list has rows.
    """
    hits = dim.join(F.broadcast(top), on, "left_semi")
    return top.join(F.broadcast(hits), on, "left")


def daily(df: DataFrame, column: str, days: int = 30) -> DataFrame:
    """Counts for the most recent days that have any, with the percentage of the greatest."""
    recent = df.filter(F.col(column).isNotNull()).groupBy(F.to_date(column).alias("day")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("day")).limit(days)
    # at most ``days`` rows meet in this window
    return recent.withColumn("pct", percent(F.col("n"), F.max("n").over(Window.partitionBy(F.lit(0)))))


def bursts(df: DataFrame, key: str, column: str, ratio: float = 3.0, least: int = 10) -> DataFrame:
    """Keys whose busiest day exceeds their average active day by ``ratio``."""
    by_day = df.filter(F.col(column).isNotNull() & F.col(key).isNotNull()).groupBy(key, F.to_date(column).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = by_day.groupBy(key).agg(F.max("n").alias("peak"), F.avg("n").alias("mean"))
    return out.filter((F.col("peak") >= least) & (F.col("peak") / F.col("mean") >= ratio)).select(key, "peak", F.round("mean", 2).alias("mean"), F.round(F.col("peak") / F.col("mean"), 2).alias("ratio"))


def top_per_group(counted: DataFrame, group: str, key: str, n: int, measure: str = "n") -> DataFrame:
    """The n greatest keys of every group, from counts already taken.

    Spark keeps only n rows a group and task before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(group).orderBy(F.desc(measure), key)
    return counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def monthly_pivot(df: DataFrame, column: str, kind: str, kinds: Sequence[str], months: int = 12) -> DataFrame:
    """The last months by kinds, with all other kinds as "other" and a total of all rows that have a kind."""
    known = F.when(F.col(kind).isin(*kinds), F.col(kind)).when(F.col(kind).isNotNull(), "other")
    columns = [*kinds, "other"]
    counts = [F.count_if(known == k).alias(k) for k in columns]
    by = df.filter(F.col(column).isNotNull()).groupBy(F.date_format(column, "yyyy-MM").alias("month")).agg(*counts, F.count(kind).alias("total"))
    return by.orderBy(F.desc("month")).limit(months)


def preferred_estimate(*statistics: Column) -> Column:
    """The greatest of several row counts; missing and non-positive ones count as none."""
    return F.greatest(*[F.coalesce(s, F.lit(0)) for s in statistics], F.lit(0)).cast("long")


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 3.6e9
