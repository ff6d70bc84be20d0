"""Search: a small query language, its predicate, paging, facets and ranking.

A query is split like a shell line.  ``key:value`` words with a known key are
structured filters, OR within a key and AND across keys; all others are terms,
each of which must occur in one of the searched columns.  ``%`` and ``_`` in a
term act as wildcards.  Everything becomes one predicate before any limit, so
Catalyst pushes it to the scan and nothing is lost to a cap.
"""

from __future__ import annotations

import re
import shlex
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from siltstone.session import hadoop_path, ship, workspace

KEYS = ("domain", "stealer", "application", "email_domain", "username", "url", "since")
COLUMNS = {"stealer": "stealer_type"}


def parse_query(q: str) -> tuple[list[str], dict[str, list[str]]]:
    """(terms, filters) of a query; unbalanced quotes fall back to words."""
    try:
        words = shlex.split(q)
    except ValueError:
        words = q.split()
    terms, filters = [], {}
    for w in words:
        key, colon, value = w.partition(":")
        if colon and value and key.lower() in KEYS:
            filters.setdefault(key.lower(), []).append(value)
        else:
            terms.append(w)
    return terms, filters


def since_bound(value: str, now: str) -> Column | None:
    """The instant meant by 12h, 7d or 2017-03-01; None for anything else."""
    if m := re.fullmatch(r"(\d+)([hd])", value.strip().lower()):
        return F.lit(now).cast("timestamp") - F.expr(f"interval {int(m[1])} {'hours' if m[2] == 'h' else 'days'}")
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", value.strip()):
        return F.lit(value.strip()).cast("timestamp")
    return None


def predicate(q: str, columns: Sequence[str] = ("domain", "username", "email_domain"), now: str = "2017-03-31 00:00:00", time: str = "created_at", whole: bool = False) -> Column:
    """The whole query as one condition; with ``whole`` a term is a pattern for the whole field."""
    terms, filters = parse_query(q)
    parts = [reduce(lambda a, b: a | b, [F.col(c).ilike(t if whole else f"%{t}%") for c in columns]) for t in terms]
    for key, values in filters.items():
        if key == "since":
            bounds = [b for v in values if (b := since_bound(v, now)) is not None]
            parts += [F.col(time) >= b for b in bounds]
        else:
            parts.append(reduce(lambda a, b: a | b, [F.col(COLUMNS.get(key, key)).ilike(f"%{v}%") for v in values]))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def matches_any(pattern: str, columns: Sequence[str]) -> Column:
    """A regular expression, case ignored, in any of the columns; an invalid one filters nothing."""
    try:
        re.compile(pattern)
    except re.error:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c).rlike("(?i)" + pattern), F.lit(False)) for c in columns])


def without_sources(df: DataFrame, column: str, excluded: DataFrame, keep_null: bool = True) -> DataFrame:
    """Rows whose source is not excluded; a row without a source stays, or goes."""
    out = df.join(excluded.select(F.col(excluded.columns[0]).alias(column)).distinct(), column, "left_anti")
    return out if keep_null else out.filter(F.col(column).isNotNull())


def identity(soft: str = "soft_credential_hash", full: str = "credential_hash", key: str = "id") -> Column:
    return F.coalesce(soft, full, F.col(key).cast("string"))


def keep_first(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key; only one row a key and task is shuffled."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def page(df: DataFrame, order: Sequence[Column], size: int, number: int) -> DataFrame:
    return df.orderBy(*order).offset(size * (number - 1)).limit(size)


def bm25(docs: DataFrame, key: str, text: str, terms: Sequence[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) of the documents that hold any of the terms.

    Statistics are of the whole table and enter as scalar subqueries; nothing
    but partial sums is shuffled.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def times(term: str) -> Column:
        return F.size(F.filter("w", lambda x: x == F.lit(term)))

    counted = docs.select(key, words.alias("w")).select(key, F.size("w").alias("len"), *[times(t).alias(f"tf{i}") for i, t in enumerate(terms)])
    stats = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    both = counted.filter(reduce(lambda a, c: a | c, [F.col(f"tf{i}") > 0 for i in range(len(terms))]))
    n, mean, score = stats.select("n").scalar(), stats.select("mean").scalar(), F.lit(0.0)
    for i in range(len(terms)):
        df = stats.select(f"df{i}").scalar()
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        score = score + idf * F.col(f"tf{i}") * (k1 + 1) / (F.col(f"tf{i}") + k1 * (1 - b + b * F.col("len") / mean))
    return both.select(key, F.round(score, 6).alias("score"))


#: Characters of needles that one automaton takes; more needles are looked for in further scans.
NEEDLE_CHARS = 1_000_000


def _needle_blocks(needles: DataFrame) -> Iterator[list[tuple]]:
    """Rows (needle, ...) in blocks of at most NEEDLE_CHARS characters; a longer needle stands alone.

    The blocks are made finer until the sums of their lengths fit; only then is one at a time collected.
    """
    n = max(1, -(-(needles.agg(F.sum(F.length("_needle"))).first()[0] or 0) // NEEDLE_CHARS))
    while True:
        block = F.pmod(F.xxhash64(*needles.columns), F.lit(n))
        sizes = needles.groupBy(block.alias("b")).agg(F.sum(F.length("_needle")).alias("chars"), F.count(F.lit(1)).alias("n"))
        if not sizes.filter((F.col("chars") > NEEDLE_CHARS) & (F.col("n") > 1)).limit(1).count():
            break
        n *= 2
    for b in range(n):
        if held := [tuple(r) for r in needles.filter(block == b).collect()]:
            yield held


def contains_many(rows: DataFrame, keys: Sequence[str], text: str, needles: DataFrame, needle_key: str, needle: str, on: Sequence[str] = ()) -> DataFrame:
    """(keys, needle_key) wherever a text contains a needle, case ignored, for any number of needles.

    The needles of a block form an automaton that reads each text once, however
    many they are; nothing is shuffled.  Columns in ``on`` must agree, too.  An
    empty needle is in no text.
    """
    spark = rows.sparkSession
    ship(spark)
    kinds = {**dict(rows.dtypes), needle_key: dict(needles.dtypes)[needle_key]}
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in (*keys, needle_key))
    asked = needles.filter(F.length(needle) > 0).select(F.lower(F.col(needle)).alias("_needle"), F.col(needle_key), *on).distinct()
    texts = rows.filter(F.length(text) > 0).select(*keys, *on, F.lower(F.col(text)).alias("_low"))
    names, at, out = [*keys, needle_key], len(keys), None
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    for block in _needle_blocks(asked):
        words: dict[str, list[tuple]] = {}
        for word, key, *where in block:
            words.setdefault(word, []).append((key, tuple(where)))
        shared = spark.sparkContext.broadcast(words)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for word, owners in shared.value.items():
                automaton.add_word(word, owners)
            automaton.make_automaton()
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                lows, wheres = columns[-1], columns[at:-1]
                which, found = [], []
                for r, low in enumerate(lows):
                    where = tuple(w[r] for w in wheres)
                    hit = {key for _, owners in automaton.iter(low) for key, place in owners if place == where}
                    which += [r] * len(hit)
                    found += hit
                if which:
                    held = batch.take(pa.array(which))
                    yield pa.RecordBatch.from_arrays([*held.columns[:at], pa.array(found, schema.field(at).type)], names=names)

        part = texts.mapInArrow(scan, ddl)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], ddl) if out is None else out


class SavedSearches:
    """Queries kept under a name in the shared folder; saving a name again replaces it."""

    SCHEMA = "name string, query string, version long"

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root or workspace(spark, "searches")

    def _versions(self) -> DataFrame:
        fs, p = hadoop_path(self.spark, self.root)
        return self.spark.read.schema(self.SCHEMA).parquet(self.root) if fs.exists(p) else self.spark.createDataFrame([], self.SCHEMA)

    def _append(self, name: str, query: str | None) -> None:
        version = (self._versions().agg(F.max("version")).first()[0] or 0) + 1
        self.spark.createDataFrame([(name, query, version)], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.root)

    def save(self, name: str, query: str) -> None:
        self._append(name, query)

    def remove(self, name: str) -> None:
        self._append(name, None)

    def all(self) -> DataFrame:
        """(name, query) by name."""
        return self._versions().groupBy("name").agg(F.max_by("query", "version").alias("query")).filter("query is not null").orderBy("name")

    def run(self, records: DataFrame, **how) -> DataFrame:
        """Hits of every saved query, with its name; each query is one predicate over the one scan."""
        found = [F.when(predicate(r["query"], **how), F.lit(r["name"])) for r in self.all().collect()]  # as many as users saved
        return records.withColumn("name", F.explode(F.array_compact(F.array(*found) if found else F.array().cast("array<string>"))))
