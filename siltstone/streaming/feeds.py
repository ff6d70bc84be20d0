"""Structured Streaming: incremental ingest, late data, first-seen state, watch sweeps.

Offsets live in the checkpoint, so a restart goes on where the last commit
ended; every writer is idempotent for a batch id or a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from siltstone.session import Versioned, hadoop_path, materialise, remove, workspace


def file_stream(spark: SparkSession, folder: str, schema: StructType, per_trigger: int = 1) -> DataFrame:
    """New parquet files of a folder, so many a trigger; a single file is a feed of one."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    fs, p = hadoop_path(spark, folder)
    if fs.getFileStatus(p).isFile():
        return reader.option("pathGlobFilter", p.getName()).parquet(str(p.getParent().toString()))
    return reader.parquet(folder)


def run(stream: DataFrame, write: Callable[[DataFrame, int], None], label: str, mode: str = "append", checkpoint: str | None = None) -> None:
    """Process all that is there and stop; state and offsets stay in the checkpoint."""
    at = checkpoint or workspace(stream.sparkSession, label)
    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", at).trigger(availableNow=True).start()
    q.awaitTermination()


def deduplicated(stream: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark; state is dropped as it passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, time: str, width: str, delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, width)).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "n")


def first_seen(stream: DataFrame, key: str, time: str, place: str) -> DataFrame:
    """(key, first, place, duplicates): updated as rows arrive; an earlier late row moves the first.

    A streaming aggregate, so its state stays in the JVM and takes one partial
    row for each key and task.  Rows without a time come after all that have one,
    and at one time those without a place last.
    """
    us, at = F.unix_micros(F.col(time).cast("timestamp")), F.col(place).cast("long")
    order = F.struct(us.isNull().alias("no_time"), us.alias("us"), at.isNull().alias("no_place"), at.alias("place"))
    by = stream.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("f"), (F.count(F.lit(1)) - 1).alias("duplicates"))
    return by.select(key, F.col("f.us").alias("first_us"), F.col("f.place").alias(place), "duplicates")


class LatestTable:
    """The latest version of a keyed result, from the updates of each micro-batch.

    Each micro-batch writes its updates to a folder of its own; a read takes the
    latest of each key.  After ``fold_after`` micro-batches they are folded into
    one base, which appears by a rename.  What is there is told by the folders'
    names alone, so another instance over the same root goes on, and a batch
    repeated after a failure replaces itself.
    """

    def __init__(self, spark: SparkSession, key: str, order: str, root: str | None = None, fold_after: int = 16):
        self.spark, self.key, self.order, self.root, self.fold_after = spark, key, order, root or workspace(spark, "latest"), fold_after

    def _folders(self) -> tuple[int, list[int]]:
        """The newest base and the updates after it."""
        fs, p = hadoop_path(self.spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        numbers = lambda kind: sorted(int(n.removeprefix(kind)) for n in names if n.startswith(kind))
        base = max(numbers("base-"), default=-1)
        return base, [n for n in numbers("update-") if n > base]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_b", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.root}/update-{batch_id}")
        if len(self._folders()[1]) >= self.fold_after:
            self.fold()

    def _latest(self) -> DataFrame | None:
        base, updates = self._folders()
        dirs = [f"{self.root}/base-{base}"] * (base >= 0) + [f"{self.root}/update-{n}" for n in updates]
        if not dirs:
            return None
        rows = self.spark.read.parquet(*dirs)
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != self.key]), F.struct("_b", self.order)).alias("s")).select(self.key, "s.*")

    def fold(self) -> None:
        base, updates = self._folders()
        if not updates:
            return
        held = f"{self.root}/_{uuid.uuid4().hex[:12]}"
        self._latest().write.parquet(held)
        fs, p = hadoop_path(self.spark, held)
        fs.rename(p, hadoop_path(self.spark, f"{self.root}/base-{updates[-1]}")[1])
        for old in [f"base-{base}"] * (base >= 0) + [f"update-{n}" for n in updates]:
            remove(self.spark, f"{self.root}/{old}")

    def read(self, schema: StructType | None = None) -> DataFrame:
        rows = self._latest()
        return self.spark.createDataFrame([], schema) if rows is None else rows.drop("_b")


class Marks:
    """High-water marks by name, kept in the shared folder and moved only after the work has succeeded."""

    SCHEMA = "name string, mark long"

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.state = Versioned(spark, "marks", root)

    def get(self, name: str) -> int | None:
        row = self.state.read(self.SCHEMA).filter(F.col("name") == name).first()
        return row["mark"] if row else None

    def scan(self, rows: DataFrame, name: str, column: str, work: Callable[[DataFrame], None]) -> int | None:
        """Give ``work`` the rows beyond the mark, then move the mark to the greatest of them; returns it."""
        mark = self.get(name)
        fresh = rows if mark is None else rows.filter(F.col(column) > mark)
        top = fresh.agg(F.max(column)).first()[0]
        if top is None:
            return mark
        # what arrives meanwhile is left to the next scan
        work(fresh.filter(F.col(column) <= top))
        others = self.state.read(self.SCHEMA).filter(F.col("name") != name)
        self.state.write(others.unionByName(rows.sparkSession.createDataFrame([(name, int(top))], self.SCHEMA)).coalesce(1))
        return top


class WatchCounts:
    """Counters of watch items kept up from a stream of records: each micro-batch adds its hits to both counters of an item.

    Items that were never checked stay as they are.  A repeated micro-batch is known by its number and changes nothing.
    """

    SCHEMA = "item_id long, total long, new long, mark timestamp, batch long"

    def __init__(self, items: DataFrame, identity: Column, time: str = "created_at", root: str | None = None):
        self.items, self.identity, self.time = items, identity, time
        self.hits = Appender(items.sparkSession, "watch-hits")
        self.state = Versioned(items.sparkSession, "watch-counts", root)

    def counts(self) -> DataFrame:
        """(item_id, total, new, mark, batch) as of the last micro-batch."""
        if not self.state.versions():
            return self.items.select("item_id", F.col("last_count").alias("total"), F.col("new_count").alias("new"), F.col("last_checked_at").alias("mark"), F.lit(-1).cast("long").alias("batch"))
        return self.state.read(self.SCHEMA)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        from siltstone.operators import watch

        now = self.counts()
        if now.filter(F.col("batch") >= batch_id).limit(1).count():
            return
        marked = self.items.join(now.select("item_id", "mark"), "item_id").filter("mark is not null")
        found = materialise(watch.hits(marked, batch).filter(F.col(self.time) > F.col("last_checked_at")), "watch-batch")
        self.hits.write(found.select("item_id", "id"), batch_id)
        more = found.groupBy("item_id").agg(F.count_distinct(self.identity).alias("delta"), F.max(self.time).alias("seen"))
        delta = F.coalesce("delta", F.lit(0))
        checked = F.when(F.col("mark").isNotNull(), F.greatest("mark", "seen"))
        self.state.write(now.join(more, "item_id", "left").select("item_id", (F.col("total") + delta).alias("total"), (F.col("new") + delta).alias("new"), checked.alias("mark"), F.lit(batch_id).cast("long").alias("batch")))


class Appender:
    """Micro-batches as directories named by batch id; a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, workspace(spark, label)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def read(self, schema: StructType) -> DataFrame:
        fs, p = hadoop_path(self.spark, self.root)
        if not fs.exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(self.root)


class ProgressLog(StreamingQueryListener):
    """Runs and their progress, one entry for each micro-batch."""

    def __init__(self) -> None:
        self.entries: list[dict] = []

    def onQueryStarted(self, event) -> None:
        self.entries.append({"run": str(event.runId), "state": "started", "rows": 0})

    def onQueryProgress(self, event) -> None:
        self.entries.append({"run": str(event.progress.runId), "state": "progress", "rows": event.progress.numInputRows})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.entries.append({"run": str(event.runId), "state": "failed" if event.exception else "finished", "rows": 0})

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(e["run"], e["state"], e["rows"]) for e in self.entries], "run string, state string, rows long")


def notices(hits: DataFrame, masked_columns: list[str]) -> DataFrame:
    """Rows fit to be sent: the named columns masked, secret ones left out."""
    from siltstone.functions.text import masked
    from siltstone.sources.sinks import public

    return public(hits).withColumns({c: masked(F.col(c)) for c in masked_columns})
