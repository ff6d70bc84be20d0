"""Has this key been seen before?  A log-structured set of key hashes.

Each admitted batch leaves one immutable run: the batch's new keys, hashed to
64 bits and sorted by the hash, with the full key and the least id beside it.
A run is cut into SLOTS blocks, ranges of the hash, and its fences tell which
blocks hold keys; they are taken while the run is written.  A probe reads only
the blocks that its own hashes lie in and the run has, merge-joins them with the
batch on the hash, and a hit counts only if the full key agrees.  So no answer
is wrong; the share of hash hits that the full key refutes is reported.

Blocks lie in buckets, alike in every run, so the history is never shuffled: the
batch is, once.

When a level holds ``fan`` runs they are merged into one run of the next
level, so a probe meets at most fan-1 runs a level, and each key is rewritten
once a level.  No key is kept in memory.

Defined cases: a null key is never a case and never stored; a row without an id has
no place in the order and is left out; within a batch the
least id is the first; rows equal in id and key are the same occurrence, so
neither is later than the other; a batch that is empty or brings no new key
leaves no run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.session import discard, joined_by_part, materialise, remove, short_shuffles, shuffle_width, workspace

#: Blocks of a run, by the leading ten bits of the hash.
SLOTS = 1_024


def _slot(h: Column) -> Column:
    return F.shiftrightunsigned(h, 54).cast("int")


def _same(a: Column, b: Column) -> Column:
    """Equality that stays a check behind the merge join instead of a further join key."""
    return F.greatest(a, b) == F.least(a, b)


class SeenKeys:
    """The set of keys seen so far, in levels of sorted runs."""

    def __init__(self, spark: SparkSession, fan: int = 3, buckets: int | None = None):
        self.spark, self.fan, self.buckets = spark, fan, buckets or shuffle_width(spark)
        self.root = workspace(spark, "seen")
        self.levels: list[list[dict]] = [[]]

    def _write(self, rows: DataFrame) -> dict:
        """One run (slot, h, key, first_id), and its fences."""
        name = f"seen_{uuid.uuid4().hex[:16]}"
        path, seen = f"{self.root}/{name}", Observation()
        placed = rows.select(_slot(F.col("h")).alias("slot"), "h", "key", "first_id")
        # at most SLOTS numbers
        told = placed.observe(seen, F.count(F.lit(1)).alias("rows"), F.min("h").alias("low"), F.max("h").alias("high"), F.collect_set("slot").alias("blocks"))
        with short_shuffles(self.spark):
            told.repartition(self.buckets, "slot").write.bucketBy(self.buckets, "slot").sortBy("slot", "h").option("path", path).saveAsTable(name)
        got = seen.get
        return {"name": name, "path": path, "rows": got["rows"], "low": got["low"], "high": got["high"], "blocks": set(got["blocks"])}

    def runs(self) -> list[dict]:
        return [r for level in self.levels for r in level]

    def _meeting(self, firsts: DataFrame) -> list[DataFrame]:
        """Of each run the blocks that ``firsts`` has hashes in, under other names."""
        asked = {r[0] for r in firsts.select(_slot(F.col("h"))).distinct().collect()}  # at most SLOTS
        out = []
        for run in self.runs():
            if blocks := asked & run["blocks"]:
                old = self.spark.table(run["name"]).select(F.col("slot").alias("_slot"), F.col("h").alias("_h"), F.col("key").alias("seen_key"), F.col("first_id").alias("seen_id"))
                out.append(old if len(blocks) == len(run["blocks"]) else old.filter(F.col("_slot").isin(sorted(blocks))))
        return out

    def unseen(self, firsts: DataFrame) -> DataFrame:
        """The (h, key, first_id) rows whose key is in no run, written; ``firsts`` is a written table."""
        left = firsts.withColumn("slot", _slot(F.col("h")))
        for old in self._meeting(firsts):
            left = left.join(old, (F.col("slot") == F.col("_slot")) & (F.col("h") == F.col("_h")) & _same(F.col("key"), F.col("seen_key")), "left_anti")
        with joined_by_part(self.spark):
            return materialise(left.select("h", "key", "first_id"), "unseen")

    def hits(self, firsts: DataFrame) -> DataFrame:
        """One row: keys probed, keys with a hash hit, and hits the full key confirmed.

        Keys of ``firsts`` that share a hash no run has are hits too, all but one,
        as by the hash alone each would be taken for the one before it.
        """
        out = firsts.select(_slot(F.col("h")).alias("slot"), "h", "key")
        pairs = out.select("h", "key", F.lit(True).alias("own"), F.lit(False).alias("real"))
        for old in self._meeting(firsts):
            met = out.join(old, (F.col("slot") == F.col("_slot")) & (F.col("h") == F.col("_h")))
            pairs = pairs.unionByName(met.select("h", "key", F.lit(False).alias("own"), _same(F.col("key"), F.col("seen_key")).alias("real")))
        per_key = pairs.groupBy("h", "key").agg(F.bool_or(~F.col("own")).alias("hit"), F.bool_or("real").alias("real"))
        per_hash = per_key.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.bool_or("hit").alias("hit"), F.count_if("real").alias("real"))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        counts = per_hash.agg(total("n").alias("probed"), total(F.when(F.col("hit"), F.col("n")).otherwise(F.col("n") - 1)).alias("hash_hits"), total("real").alias("confirmed"))
        with joined_by_part(self.spark):
            return materialise(counts, "hits")

    def firsts(self, batch: DataFrame) -> DataFrame:
        """(h, key, first_id): the least id of each key of (id, key) rows."""
        return batch.filter(F.col("key").isNotNull()).groupBy(F.xxhash64("key").alias("h"), "key").agg(F.min("id").alias("first_id"))

    def admit(self, batch: DataFrame) -> DataFrame:
        """Store the keys of (id, key) rows that were not seen before; these come back as (h, key, first_id)."""
        firsts = materialise(self.firsts(batch), "firsts")
        new = self._admit(firsts)
        discard(firsts)
        return new

    def _admit(self, firsts: DataFrame) -> DataFrame:
        new = self.unseen(firsts)
        # without rows the adaptive plan drops the observation that tells the fences
        if not new.isEmpty():
            self.levels[0].append(self._write(new))
            self._compact()
        return new

    def _compact(self) -> None:
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fan:
                merged = None
                for run in self.levels[k]:
                    t = self.spark.table(run["name"])
                    merged = t if merged is None else merged.unionByName(t)
                run = self._write(merged)
                for old in self.levels[k]:
                    self.spark.sql(f"DROP TABLE {old['name']}")
                    remove(self.spark, old["path"])
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(run)

    def keys(self) -> DataFrame:
        """(h, key, first_id) of every key seen."""
        out = None
        for run in self.runs():
            t = self.spark.table(run["name"]).select("h", "key", "first_id")
            out = t if out is None else out.unionByName(t)
        return self.spark.createDataFrame([], "h long, key binary, first_id long") if out is None else out


def id_slices(table: DataFrame, id_column: str, steps: int) -> list[Column]:
    """Conditions that cut a table into consecutive ranges of ids."""
    low, high = table.agg(F.min(id_column), F.max(id_column)).first()
    if low is None:
        return []
    width = -(-(high - low + 1) // steps)
    return [F.col(id_column).between(at, at + width - 1) for at in range(low, high + 1, width)]


def _keyed(table: DataFrame, id_column: str, key_column: str) -> DataFrame:
    return table.select(F.col(id_column).alias("id"), F.encode(key_column, "UTF-8").alias("key")).filter("key is not null and id is not null")


def _parts(table: DataFrame, id_column: str, key_column: str, steps: int) -> list[DataFrame]:
    """(id, key) rows of consecutive ranges of ids."""
    return [_keyed(table.filter(part), id_column, key_column) for part in id_slices(table, id_column, steps)]


def seen_before(table: DataFrame, id_column: str = "id", key_column: str = "credential_hash", steps: int = 4) -> DataFrame:
    """Rows (id, key) whose key was on a row with a lower id.

    The table goes through the set in ``steps`` ranges of ids.  Of a range each row
    is a case but those that brought a key no run had, as the probe tells.
    """
    seen, out = SeenKeys(table.sparkSession), None
    for rows in _parts(table, id_column, key_column, steps):
        new = seen.admit(rows)
        found = materialise(rows.join(new.select(F.col("first_id").alias("id"), "key"), ["id", "key"], "left_anti"), "seen-rows")
        discard(new)
        out = found if out is None else out.unionByName(found)
    return _keyed(table, id_column, key_column).limit(0) if out is None else out


def error_rate(table: DataFrame, id_column: str = "id", key_column: str = "credential_hash", steps: int = 4) -> DataFrame:
    """One row: every range of ids probed against all before it, and the wrong answers, summed.

    ``wrong_by_hash`` is the share of hash hits that are another key, of an
    earlier range or of the same.  ``wrong_after_check`` is the share of probes
    answered wrongly by the store: the keys of the table are grouped anew, and a
    key is wrong if the store does not hold it just once, with its least id.
    """
    spark, rows = table.sparkSession, _keyed(table, id_column, key_column)
    parts, seen = _parts(table, id_column, key_column, steps), SeenKeys(table.sparkSession)
    counts = [0, 0, 0]
    for part in parts:
        firsts = materialise(seen.firsts(part), "firsts")
        counts = [a + b for a, b in zip(counts, seen.hits(firsts).first())]
        discard(firsts, seen._admit(firsts))
    probed, hash_hits, confirmed = counts
    shape = "probed long, hash_hits long, confirmed long, wrong_by_hash double, wrong_after_check double"
    if not parts:
        return spark.createDataFrame([], shape)
    wrong = wrong_keys(rows, seen)
    return spark.createDataFrame([(probed, hash_hits, confirmed, (hash_hits - confirmed) / hash_hits if hash_hits else 0.0, wrong / probed if probed else 0.0)], shape)


def wrong_keys(rows: DataFrame, seen: SeenKeys) -> int:
    """Keys of (id, key) rows that the store does not hold just once, with their least id."""
    none = F.lit(None).cast("long")
    both = rows.select("key", "id", none.alias("stored")).unionByName(seen.keys().select("key", none.alias("id"), F.col("first_id").alias("stored")))
    per_key = both.groupBy("key").agg(F.min("id").alias("least"), F.count("stored").alias("times"), F.min("stored").alias("stored"))
    return per_key.agg(F.count_if((F.col("times") != 1) | ~F.col("stored").eqNullSafe(F.col("least")))).first()[0]
