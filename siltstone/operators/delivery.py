"""Exactly one copy of messages that were delivered more than once.

The store keeps one winner for each identifier in partitions by day of first
delivery.  An identifier index, appended to and never rewritten, names the
partition that holds each identifier.  It is bucketed by slots, neighbouring
message numbers of one conversation sharing a slot, so a batch reads the buckets
it has slots in and shuffles nothing of them.  Merging a batch

1. reduces the batch to one winner for each identifier (map-side combined, so
   a hot identifier costs one row for each map task),
2. joins the batch's identifiers with the index to find the partitions that
   already hold some of them,
3. reads those partitions only, unites them with the batch and recomputes the
   winners,
4. writes the new versions beside the old ones and commits them all at once by
   renaming a manifest.  Readers see the old or the new state, nothing between.

Partitions without an affected identifier are neither read nor rewritten: new
identifiers of such a day are appended as further files.  A partition larger
than a task should write is split over several, that of rows without an
identifier as well.  Versions that neither of the last two commits names are removed.

If a writer dies before its commit, its rows of the index stay.  They name a
partition that lacks the identifier as yet, and the next merge puts it there.

The winner is the copy with the latest edit_date (none counts as earliest),
then the latest delivered_at, then the highest delivery_id; ties beyond that
are equal in all three and either row may stay.  A row with a null in the
identifier has no identity: it is kept as it is, in the partition "unkeyed".
Empty batches leave the state as it was.  Columns beyond those named travel
with the winner; an input column named "copies" comes out as "copies_in".
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.columns import make_room
from siltstone.session import Buckets, hadoop_path, joined_by_part, remove, short_shuffles, shuffle_width, workspace

UNKEYED = "unkeyed"
#: Slots of the identifier index, and how many neighbouring message numbers share one.
SLOTS, NEIGHBOURS = 1_024, 256
#: Commits whose files stay readable.
KEPT = 2


class DeliveryStore:
    """A versioned table with one row for each (conversation, message) pair."""

    def __init__(self, spark: SparkSession, root: str | None = None, keys: tuple[str, ...] = ("conversation_id", "platform_id"), order: tuple[str, ...] = ("edit_date", "delivered_at", "delivery_id"), day: str = "delivered_at"):
        self.spark, self.root = spark, root or workspace(spark, "deliveries")
        self.keys, self.order, self.day = list(keys), list(order), day
        self.index: Buckets | None = None

    # -- the manifest -----------------------------------------------------
    def _manifest(self) -> tuple[int, dict]:
        fs, p = hadoop_path(self.spark, f"{self.root}/_manifests")
        if not fs.exists(p):
            return 0, {"parts": {}, "index": None, "schema": None}
        versions = [int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")]
        if not versions:
            return 0, {"parts": {}, "index": None, "schema": None}
        v = max(versions)
        return v, json.loads(self.spark.read.text(f"{self.root}/_manifests/{v:08d}.json", wholetext=True).first()[0])

    def _commit(self, version: int, state: dict) -> None:
        """The new state appears by one rename; a second writer of the same version fails."""
        fs, tmp = hadoop_path(self.spark, f"{self.root}/_manifests/.{version:08d}.tmp")
        _, final = hadoop_path(self.spark, f"{self.root}/_manifests/{version:08d}.json")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(tmp, final):
            raise RuntimeError(f"another writer committed version {version} first")

    # -- merging ----------------------------------------------------------
    def _winners(self, rows: DataFrame) -> DataFrame:
        """One row a key: the greatest by the order columns, copies and first day combined."""
        cols = [c for c in rows.columns if c not in (*self.keys, "_s_copies", "_s_part")]
        lead = [F.col(c).alias(f"_s_o{i}") for i, c in enumerate(self.order)]
        best = F.max_by(F.struct(*cols), F.struct(*[F.struct(c.isNotNull(), c) for c in lead]))
        return rows.groupBy(*self.keys).agg(best.alias("_s_w"), F.sum("_s_copies").alias("_s_copies"), F.min("_s_part").alias("_s_part")).select(*self.keys, *[F.col("_s_w")[c].alias(c) for c in cols], "_s_copies", "_s_part")

    def _slot(self, rows: DataFrame) -> DataFrame:
        """With the slot of each identifier: numbers close together share it, so a batch meets few."""
        *lead, number = self.keys
        block = F.floor(F.col(number) / NEIGHBOURS) if dict(rows.dtypes)[number] in ("int", "bigint", "smallint") else F.col(number)
        return rows.withColumn("_s_slot", F.pmod(F.xxhash64(*lead, block), F.lit(SLOTS)).cast("int"))

    def _open_index(self, state: dict) -> Buckets:
        if self.index is None:
            known = state["index"]
            self.index = Buckets(self.spark, "delivery_index", "_s_slot", known["buckets"] if known else shuffle_width(self.spark), f"{self.root}/index")
            if known:
                self.index.reopen(StructType.fromJson(known["schema"]))
            else:
                remove(self.spark, self.index.path)  # of a writer that died before the first commit
        return self.index

    def _located(self, fresh: DataFrame, index: Buckets) -> DataFrame:
        """Batch winners with the partition that already holds them, from the buckets the batch has slots in."""
        slots = sorted(r[0] for r in fresh.select("_s_slot").distinct().collect())  # at most SLOTS
        held = index.read().filter(F.col("_s_slot").isin(slots)).select(F.col("_s_slot").alias("_s_in"), *[F.col(k).alias(f"_s_k{i}") for i, k in enumerate(self.keys)], "_s_at")
        on = (F.col("_s_slot") == F.col("_s_in")) & reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_k{i}") for i, k in enumerate(self.keys)])
        return fresh.join(held, on, "left").drop("_s_in", *[f"_s_k{i}" for i in range(len(self.keys))])

    def merge(self, batch: DataFrame) -> list[str]:
        """Take in one batch; returns the partitions that were overwritten."""
        batch = make_room(batch, ("_s_copies", "_s_part", "_s_old", "_s_at", "_s_slot", "_s_in", "copies"))
        version, state = self._manifest()
        named = batch.withColumns({"_s_copies": F.lit(1).cast("long"), "_s_part": F.date_format(self.day, "yyyyMMdd")}).fillna({"_s_part": "undated"})
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        to, at, index = f"{self.root}/v{version + 1:08d}", version + 1, self._open_index(state)
        fresh = self._written(self._slot(self._winners(named.filter(keyed))), f"{to}/batch")
        if index.written:
            with joined_by_part(self.spark):
                located = self._located(fresh, index).withColumns({"_s_old": F.col("_s_at").isNotNull(), "_s_part": F.coalesce("_s_at", "_s_part")}).drop("_s_at")
                located = self._written(located, f"{to}/located")
        else:
            located = fresh.withColumn("_s_old", F.lit(False))
        # as many rows as there are days, never as many as there are identifiers
        hit = sorted(r[0] for r in located.filter("_s_old").select("_s_part").distinct().collect())
        parts, written = dict(state["parts"]), [c for c in located.columns if c not in ("_s_old", "_s_slot")]
        if hit:
            known = located.filter(F.col("_s_part").isin(hit)).select(*written)
            self._partitions(self._winners(self._read(state, hit).unionByName(known)), f"{to}/data")
            for p in hit:
                parts[p] = [f"{to}/data/_s_part={p}"]
        added = (located.filter(~F.col("_s_part").isin(hit)) if hit else located).select(*written)
        loose = named.filter(~keyed).withColumn("_s_part", F.lit(UNKEYED)).select(*written)
        for name in self._partitions(added.unionByName(loose), f"{to}/added"):
            part = name.partition("=")[2]
            parts[part] = [*parts.get(part, []), f"{to}/added/{name}"]
        new = located.filter(~F.col("_s_old")).select("_s_slot", *self.keys, F.col("_s_part").alias("_s_at"))
        index.append(new)
        self._commit(at, {"parts": parts, "index": {"buckets": index.buckets, "schema": new.schema.jsonValue()}, "schema": added.schema.json()})
        for name in ("batch", "located"):
            remove(self.spark, f"{to}/{name}")
        self._vacuum(at)
        return hit

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        with short_shuffles(self.spark):
            rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _partitions(self, rows: DataFrame, path: str) -> list[str]:
        """Write rows by partition, small ones together in a task and large ones split; the folders' names."""
        with short_shuffles(self.spark):
            rows.hint("rebalance", "_s_part").write.partitionBy("_s_part").parquet(path)
        fs, p = hadoop_path(self.spark, path)
        return [name for s in fs.listStatus(p) if (name := s.getPath().getName()).startswith("_s_part=")]

    def _vacuum(self, version: int) -> None:
        """Remove versions' folders that the last KEPT commits do not name, and older manifests."""
        used, last = set(), max(1, version - KEPT + 1)
        for v in range(last, version + 1):
            state = json.loads(self.spark.read.text(f"{self.root}/_manifests/{v:08d}.json", wholetext=True).first()[0])
            used |= {d for dirs in state["parts"].values() for d in dirs}
        fs, p = hadoop_path(self.spark, self.root)
        for folder in fs.listStatus(p):
            name = folder.getPath().getName()
            if not name.startswith("v") or int(name[1:]) > version:
                continue
            for kind in ("data", "added"):
                _, sub = hadoop_path(self.spark, f"{self.root}/{name}/{kind}")
                for part in fs.listStatus(sub) if fs.exists(sub) else []:
                    at = part.getPath().getName()
                    if at.startswith("_s_part=") and f"{self.root}/{name}/{kind}/{at}" not in used:
                        fs.delete(part.getPath(), True)
        _, manifests = hadoop_path(self.spark, f"{self.root}/_manifests")
        for m in fs.listStatus(manifests):
            name = m.getPath().getName()
            if name.endswith(".json") and int(name.removesuffix(".json")) < last:
                fs.delete(m.getPath(), False)

    # -- reading ----------------------------------------------------------
    def _read(self, state: dict, parts: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"]))
        body = StructType([f for f in schema if f.name != "_s_part"])
        dirs = [d for p in parts for d in state["parts"].get(p, [])]
        if not dirs:
            return self.spark.createDataFrame([], schema)
        part = F.regexp_extract(F.input_file_name(), r"_s_part=([^/]+)/", 1)
        return self.spark.read.schema(body).parquet(*dirs).withColumn("_s_part", part).select(*schema.names)

    def rows(self) -> DataFrame:
        """All winners as of the last commit, with ``copies`` of each."""
        _, state = self._manifest()
        return self._read(state, sorted(state["parts"])).withColumnRenamed("_s_copies", "copies").drop("_s_part")


def ingest_in_steps(messages: DataFrame, steps: int = 4, batch: str = "batch_id") -> DeliveryStore:
    """Take a table of deliveries in as ``steps`` consecutive ranges of batches."""
    store = DeliveryStore(messages.sparkSession)
    low, high = messages.agg(F.min(batch), F.max(batch)).first()
    if low is None:
        store.merge(messages)
        return store
    width = -(-(high - low + 1) // steps)
    for i, at in enumerate(range(low, high + 1, width)):
        part = F.col(batch).between(at, at + width - 1)
        store.merge(messages.filter(part | F.col(batch).isNull() if i == 0 else part))
    return store
