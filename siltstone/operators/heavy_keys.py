"""Counts and exact quantiles for each key when a few keys hold most rows.

1. Every row becomes (field, key, value) for each key column, and equal triples
   are counted.  The count is combined on the map side and spread over
   (field, key, value), so neither a hot key nor a hot value meets in one task.
2. The values, as distances from the least one, are read as digits of ten
   bits.  A histogram of the leading digit for each key gives the digit in
   which each wanted rank lies and the rank left within it; the next round
   looks only at values with that prefix, until the last digit resolves the
   value itself.  Histograms are counts, mergeable on the map side, of at most
   1024 bins a key and prefix; the values of a hot key never come together.

Defined cases: a null key is no key (its rows count into ``total`` only); null
values count into ``n`` but not into the ranks, and a key with none but null
values has null quantiles; the quantile p is the value at rank ceil(p% of m) of
the m values in ascending order (the first for p=0); ties are equal values and
need no rule; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import materialise

DIGIT_BITS = 10


def key_histogram(rows: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """(field, key_value, v, c): how often each value occurs with each key, nulls included."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).cast("string").alias("key_value")) for k in keys])
    return rows.select(F.explode(pairs).alias("p"), F.col(value).cast("long").alias("v")).select("p.field", "p.key_value", "v").groupBy("field", "key_value", "v").agg(F.count(F.lit(1)).alias("c"))


def counts_and_quantiles(rows: DataFrame, keys: tuple[str, ...], value: str, percents: tuple[int, ...] = (25, 50, 90)) -> DataFrame:
    """(field, key_value, n, total, q<percent>...) for every value of every key column."""
    hist = materialise(key_histogram(rows, keys, value), "histogram")
    sizes = hist.groupBy("field", "key_value").agg(F.sum("c").alias("n"), F.sum(F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0)).alias("m"))
    sizes = materialise(sizes, "sizes")
    # one row for each key column
    total = sizes.groupBy("field").agg(F.sum("n").alias("total"))
    low, high = hist.agg(F.min("v"), F.max("v")).first()
    wanted = F.explode(F.array(*[F.lit(p) for p in percents]))
    state = sizes.filter("key_value is not null and m > 0").select("field", "key_value", wanted.alias("percent"), "m").withColumns({"rank": F.greatest(F.expr("(m * percent + 99) div 100"), F.lit(1)).cast("long"), "prefix": F.lit(0).cast("long")}).drop("m")
    if low is not None:
        digits = max(1, -(-max(1, int(high - low).bit_length()) // DIGIT_BITS))
        off = hist.filter("key_value is not null and v is not null").withColumn("d", F.col("v") - F.lit(low))
        for level in range(digits):
            shift = DIGIT_BITS * (digits - 1 - level)
            at = off.withColumns({"prefix": F.shiftright("d", shift + DIGIT_BITS) if level else F.lit(0).cast("long"), "digit": F.shiftright("d", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))})
            on = ["field", "key_value", "prefix"]
            if level:
                # the wanted prefixes grow with the keys, so they are merged, never broadcast
                at = at.join(state.select(*on).distinct().hint("merge"), on, "left_semi")
            bins = at.groupBy(*on, "digit").agg(F.sum("c").alias("c"))
            upto = F.sum("c").over(Window.partitionBy(*on).orderBy("digit"))
            cum = bins.withColumn("upto", upto)
            state = (
                state.hint("merge").join(cum, on)
                .filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("c")))
                .select("field", "key_value", "percent", (F.col("rank") - (F.col("upto") - F.col("c"))).alias("rank"), (F.shiftleft("prefix", DIGIT_BITS) + F.col("digit")).alias("prefix"))
            )
            state = materialise(state, f"ranks-{level}")
        state = state.withColumn("value", F.col("prefix") + F.lit(low))
    else:
        state = state.withColumn("value", F.lit(None).cast("long"))
    found = state.groupBy("field", "key_value").agg(*[F.max(F.when(F.col("percent") == p, F.col("value"))).alias(f"q{p}") for p in percents])
    # total has one row for each key column, so its size is fixed by the call
    return sizes.filter("key_value is not null").join(F.broadcast(total), "field").join(found.hint("merge"), ["field", "key_value"], "left").select("field", "key_value", "n", "total", *[f"q{p}" for p in percents])
