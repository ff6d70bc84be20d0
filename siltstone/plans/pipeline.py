"""The batch pipeline as transforms over tables.

Ingest, channel_discover, discover, plan, acquire, enrich, parse, finalise: each
stage is a function of DataFrames.  Finding or joining channels, fetching and
opening archives are not part of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import files
from siltstone.operators import dedup, grouping
from siltstone.operators.delivery import ingest_in_steps
from siltstone.operators.repair_parse import parse_records
from siltstone.plans.registry import Tables
from siltstone.session import materialise


@dataclass
class Run:
    """What the stages made, and which of them failed; later stages still run."""

    made: dict[str, DataFrame] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


def ingest(t: Tables, run: Run) -> DataFrame:
    """One row for each message."""
    return ingest_in_steps(t.messages).rows()


def channel_discover(t: Tables, run: Run) -> DataFrame:
    """Channels by their first source, those already known told apart."""
    from siltstone.plans.search_queries import discovery

    found = discovery(t.channels, t.messages, t.documents, "text", t.file_attachments)
    return found.join(t.channels.select(F.col("platform_id").cast("string").alias("channel"), F.lit(True).alias("known")), "channel", "left")


def discover(t: Tables, run: Run) -> DataFrame:
    a = t.file_attachments
    return a.withColumn("class", files.attachment_class(F.col("filename"), F.col("mime_type"), F.col("size"))).withColumn("candidate", F.col("class").isin("split", "archive", "text", "untyped"))


def plan(t: Tables, run: Run) -> DataFrame:
    """Parts of archives with their group; a part whose message is gone is left out."""
    m = t.messages.select("conversation_id", F.col("platform_id").alias("message_id"))
    held = run.made["discover"].filter("candidate").join(m, ["conversation_id", "message_id"], "left_semi")
    return grouping.parts(held)


def acquire(t: Tables, run: Run) -> DataFrame:
    """Parts with the state of their group: READY if every number up to the stated or highest one is there, else WAITING."""
    p = run.made["plan"]
    by = p.groupBy("group").agg(F.count_distinct("part").alias("there"), F.coalesce(F.max("total"), F.max("part"), F.lit(0)).alias("last"), F.coalesce(F.min("part"), F.lit(1)).alias("low"))
    # sets may count from 0 or from 1
    state = F.when(F.col("there") >= F.col("last") + F.when(F.col("low") == 0, 1).otherwise(0), "READY").otherwise("WAITING")
    return p.join(by.select("group", state.alias("state")), "group")


def enrich(t: Tables, run: Run) -> DataFrame:
    """Forwarded messages with archives, and the channel they come from if it is known."""
    a = run.made["discover"].filter("candidate").select("conversation_id", F.col("message_id").alias("platform_id"))
    forwarded = run.made["ingest"].filter("is_forwarded and forwarded_from_id is not null").join(a, ["conversation_id", "platform_id"], "left_semi")
    origin = t.channels.select(F.col("platform_id").alias("forwarded_from_id"), F.col("title").alias("origin_title"))
    return forwarded.select("conversation_id", "platform_id", "forwarded_from_id").join(origin, "forwarded_from_id", "left")


def parse(t: Tables, run: Run) -> DataFrame:
    """Valid rows that are new: not of files already parsed for the same job, the first of each record."""
    rows = parse_records(t.raw_lines).filter("status = 'loaded'").withColumn("job", F.col("extraction_job_id").cast("long"))
    parsed = t.parsed_credentials.select(F.col("extraction_job_id").alias("job"), "source_file").distinct()
    fresh = rows.join(parsed, ["job", "source_file"], "left_anti").withColumn("record_key", F.concat_ws("\u0001", "url", "username", "password_digest"))
    return dedup.new_rows(fresh, fresh.limit(0), "record_key", F.col("source_file"), F.col("line_number"))


def finalise(t: Tables, run: Run) -> DataFrame:
    """First sightings of each content, every text."""
    return dedup.first_seen(t.documents, F.sha2("text", 256), "platform_timestamp", ["conversation_id"], "doc_id")


def count_records(t: Tables, run: Run) -> DataFrame:
    """Records of each job, counted once for those who list jobs."""
    return t.parsed_credentials.filter("extraction_job_id is not null").groupBy("extraction_job_id").agg(F.count(F.lit(1)).alias("records"))


def prune(t: Tables, run: Run) -> DataFrame:
    """Sheets that are still needed: those of jobs without records."""
    return t.system_info.join(run.made["count_records"], "extraction_job_id", "left_anti")


STAGES = {
    "ingest": ingest,
    "channel_discover": channel_discover,
    "discover": discover,
    "plan": plan,
    "acquire": acquire,
    "enrich": enrich,
    "parse": parse,
    "finalise": finalise,
    "count_records": count_records,
    "prune": prune,
}


def run_pipeline(t: Tables, stages: dict = STAGES) -> Run:
    """Run the stages in order; each result is written, so a later stage reads it and a failure shows where it happens."""
    run = Run()
    for name, stage in stages.items():
        try:
            run.made[name] = materialise(stage(t, run), name)
        except Exception as e:  # recorded; the next stage goes on
            run.failed[name] = str(e)
    return run


def report(t: Tables, run: Run) -> DataFrame:
    """(stage, state, rows): what each stage made, those that failed included."""
    out = None
    for name in [*run.made, *run.failed]:
        if name in run.made:
            one = run.made[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), F.lit("made").alias("state"), "rows")
        else:
            one = t.spark.range(1).select(F.lit(name).alias("stage"), F.lit("failed").alias("state"), F.lit(None).cast("long").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out
