"""De-duplication against a target, accounting, first-seen and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.search import keep_first
from siltstone.session import materialise, shuffle_width


def new_rows(staged: DataFrame, target: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first staged row of each key that the target lacks; rows without a key always go in."""
    keyed = keep_first(staged.filter(F.col(key).isNotNull()), F.col(key), *order)
    fresh = keyed.join(target.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return fresh.select(*staged.columns).unionByName(staged.filter(F.col(key).isNull()))


def accounting(rows: DataFrame, key: str, batch: str) -> DataFrame:
    """(batch, n, new, dup): new is a key's first row over all batches, all others are duplicates."""
    first = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(batch).alias(batch)).groupBy(batch).agg(F.count(F.lit(1)).alias("new"))
    n = rows.groupBy(batch).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("keyless"))
    new = F.coalesce("new", F.lit(0)) + F.col("keyless")
    return n.join(first, batch, "left").select(batch, "n", new.alias("new"), (F.col("n") - new).alias("dup"))


def is_dup_batch(new: Column, dup: Column, size: Column, share: float = 0.95) -> Column:
    """At least half a batch was seen and ``share`` of it were duplicates."""
    return (new + dup >= size / 2) & (dup >= share * (new + dup))


def runs_of(df: DataFrame, flag: str, order: str, part: Sequence[str]) -> DataFrame:
    """Consecutive rows of one part with the same flag, as runs (gaps and islands)."""
    w = Window.partitionBy(*part).orderBy(order)
    change = (F.col(flag) != F.lag(flag).over(w)).cast("int")
    marked = df.withColumn("_c", F.coalesce(change, F.lit(1))).withColumn("_run", F.sum("_c").over(w))
    return marked.groupBy(*part, "_run", flag).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length")).drop("_run")


def load_accounting(rows: DataFrame, key: str, load: str, batch: str, order: str) -> DataFrame:
    """(load, batch, n, new, dup): of each batch of a load, how many rows bring a key no earlier row of any load had.

    Rows are ordered by ``order``; a row without a key is new.
    """
    first = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first"))
    marked = rows.select(load, batch, order, key).join(first, key, "left")
    new = F.col(key).isNull() | (F.col(order) == F.col("_first"))
    return marked.groupBy(load, batch).agg(F.count(F.lit(1)).alias("n"), F.count_if(new).alias("new"), F.count_if(~new).alias("dup"))


def early_skips(accounts: DataFrame, load: str, batch: str, size: Column, share: float = 0.95, after: int = 3) -> DataFrame:
    """The batches with ``full`` (mostly duplicates) and ``skipped``: those behind ``after`` full ones in a row of their load."""
    w = Window.partitionBy(load).orderBy(batch)
    full = accounts.withColumn("full", is_dup_batch(F.col("new"), F.col("dup"), size, share))
    run = full.withColumn("_in_row", F.sum(F.col("full").cast("int")).over(w.rowsBetween(1 - after, 0)))
    stop = F.coalesce(F.max((F.col("_in_row") == after).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return run.withColumn("skipped", stop == 1).drop("_in_row")


def first_seen(rows: DataFrame, content: Column, time: str, place: Sequence[str], tie: str) -> DataFrame:
    """(h, first, place..., duplicates): where each content appeared first, and how often again.

    A row without a time comes after all that have one, so ``first`` is null only
    if no row has a time; a place may be null; every further row is a duplicate.
    """
    r = rows.withColumn("h", content).filter(F.col("h").isNotNull())
    by = r.groupBy("h").agg(F.min_by(F.struct(time, *place), F.struct(F.col(time).isNull(), time, tie)).alias("f"), (F.count(F.lit(1)) - 1).alias("duplicates"))
    return by.select("h", F.col("f")[time].alias("first"), *[F.col("f")[p].alias(p) for p in place], "duplicates")


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """Upsert by append: the newest version of each key."""
    return keep_first(rows.filter(F.col(key).isNotNull()), F.col(key), *order)


def union_by_priority(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """All keys of several sources; a key found twice keeps the first source's row."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("_p", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return keep_first(out, F.col(key), F.col("_p")).drop("_p")


def fill_missing(known: DataFrame, found: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Known rows whose nulls take what was found under their key, the first by ``order`` that has it; other values stay."""
    at = F.col(order)
    first = found.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_{c}") for c in columns])
    return known.join(first, key, "left").select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in known.columns])


def resolve(candidates: DataFrame, known: DataFrame, ways: Sequence[str], id_column: str) -> DataFrame:
    """Each candidate with the known row it means: the first key in ``ways`` that finds one."""
    out = candidates
    for i, way in enumerate(ways):
        k = known.filter(F.col(way).isNotNull()).groupBy(F.col(way).alias(f"_k{i}")).agg(F.min(id_column).alias(f"_id{i}"))
        out = out.join(k, F.col(way) == F.col(f"_k{i}"), "left")
    return out.withColumn("resolved", F.coalesce(*[F.col(f"_id{i}") for i in range(len(ways))])).drop(*[f"_k{i}" for i in range(len(ways))], *[f"_id{i}" for i in range(len(ways))])


def nearest(rows: DataFrame, group: str, position: str, n: int = 2) -> DataFrame:
    """(group, position, near, distance): the 2n rows of the group nearest to each, the lesser position first at one distance.

    The rows are range-partitioned by (group, position), so a large group lies in
    many tasks.  Each range's first and last 2n rows of a group, the edges, are
    few; from them each range learns the 2n rows before and after it, and
    neighbours are then found within ranges by lag and lead.
    """
    reach, spark = 2 * n, rows.sparkSession
    known = rows.select(group, position).filter(F.col(group).isNotNull() & F.col(position).isNotNull()).distinct()
    ranges = materialise(known.repartitionByRange(shuffle_width(spark), group, position).withColumn("_range", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_range", group)
    edge = ranges.withColumns({"_up": F.row_number().over(own.orderBy(position)), "_down": F.row_number().over(own.orderBy(F.desc(position)))}).filter((F.col("_up") <= reach) | (F.col("_down") <= reach))
    # at most 4n rows for each range and group
    across = Window.partitionBy(group).orderBy(position)
    around = [(F.lag, "_up", k) for k in range(1, reach + 1)] + [(F.lead, "_down", k) for k in range(1, reach + 1)]
    ghosts = F.array_compact(F.array(*[F.when(F.col(side) == 1, f(position, k).over(across)) for f, side, k in around]))
    beyond = edge.select("_range", group, ghosts.alias("_g")).select("_range", group, F.explode("_g").alias(position), F.lit(True).alias("_ghost"))
    within = own.orderBy(position)
    near = F.array_compact(F.array(*[f(position, k).over(within) for k in range(1, reach + 1) for f in (F.lag, F.lead)]))
    both = ranges.select("_range", group, position, F.lit(False).alias("_ghost")).unionByName(beyond).withColumn("_a", near).filter(~F.col("_ghost"))
    by_distance = F.slice(F.array_sort(F.transform("_a", lambda x: F.struct(F.abs(x - F.col(position)).alias("distance"), x.alias("near")))), 1, reach)
    return both.select(group, position, F.explode(by_distance).alias("_n")).select(group, position, "_n.near", "_n.distance")
