"""Records that differ only in formatting, collapsed by an external sort.

The canonical form of a record is its password, exactly, and the words of url
and username in sorted order.  Rows are range-partitioned by (canonical form,
id) and sorted within partitions by Spark's external sort; as the id is part of
the range key, a record that holds a third of all rows spreads over many
partitions.  One pass over each sorted partition compares adjacent full
keys and gives every row the first row of its run.

A run may cross partitions.  Only the first run of a partition can have begun
before it, so the pass marks those rows and leaves a note on each partition's
first and last run, two for each partition.  Joining the marked rows with
the notes, a table as long as twice the number of partitions, settles them.

A word is a maximal run of letters and digits in lower case; nulls are empty
texts.  Defined cases: texts without any word equal each other if the passwords
do; very long texts are compared whole; repeated rows count as copies; of equal
ids either row may come first; rows without an id are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialise, shuffle_width


def canonical(columns: tuple[str, ...], exact: str) -> Column:
    """The exact column, then the sorted words of the others."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    exact_text = F.coalesce(F.col(exact), F.lit(""))
    return F.concat(F.array_join(F.array_sort(words), " "), F.lit("\n"), exact_text)


_OUT = pa.schema([("part", pa.int64()), ("note", pa.bool_()), ("lead", pa.bool_()), ("canon", pa.string()), ("id", pa.int64()), ("variant", pa.string()), ("first_id", pa.int64()), ("first_variant", pa.string()), ("copies", pa.int64())])
_DDL = "part long, note boolean, lead boolean, canon string, id long, variant string, first_id long, first_variant string, copies long"


def _scan(batches: Iterator[pa.RecordBatch], inner_runs: bool) -> Iterator[pa.RecordBatch]:
    """Adjacent-run scan of one sorted partition of (canon, id, variant).

    Emits each row that is not the first of its run, and a note with the count
    of the partition's first and last run, of the others only if ``inner_runs``.
    Rows of the partition's first run are marked ``lead``.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    canon = first = variant = None
    lead, count = True, 0

    def rows(keep: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keep[f.name], f.type) if not isinstance(keep[f.name], pa.Array) else keep[f.name].cast(f.type) for f in _OUT], schema=_OUT)

    def note() -> dict[str, list]:
        return {"part": [part], "note": [True], "lead": [lead], "canon": [canon], "id": [None], "variant": [None], "first_id": [first], "first_variant": [variant], "copies": [count]}

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, ids, variants = (batch.column(k) for k in range(3))
        starts = np.ones(n, dtype=bool)
        if n > 1:
            starts[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts[0] = canon is None or keys[0].as_py() != canon
        begin = np.flatnonzero(starts)
        # rows before the first start continue the run carried over
        carried = int(begin[0]) if len(begin) else n
        if carried:
            yield rows({"part": [part] * carried, "note": [False] * carried, "lead": [lead] * carried, "canon": [canon] * carried if lead else [None] * carried, "id": ids.slice(0, carried), "variant": variants.slice(0, carried), "first_id": [first] * carried, "first_variant": [variant] * carried, "copies": [None] * carried})
            count += carried
        if not len(begin):
            continue
        if canon is not None:
            if lead or inner_runs:
                yield rows(note())
            lead = False
        ends = np.append(begin[1:], n)
        # runs that end in this batch
        done, sizes = begin[:-1], (ends - begin)[:-1]
        if len(done):
            first_is_lead = lead
            leads = np.zeros(len(done), dtype=bool)
            leads[0] = first_is_lead
            told = slice(None) if inner_runs else slice(0, int(first_is_lead))
            at, m = pa.array(done[told]), len(done[told])
            if m:
                yield rows({"part": [part] * m, "note": [True] * m, "lead": leads[told], "canon": pc.if_else(pa.array(leads[told]), keys.take(at), None), "id": [None] * m, "variant": [None] * m, "first_id": ids.take(at), "first_variant": variants.take(at), "copies": pa.array(sizes[told])})
            inner = np.flatnonzero(~starts[: begin[-1]])
            inner = inner[inner >= carried]
            if len(inner):
                heads = begin[np.searchsorted(begin, inner, side="right") - 1]
                in_lead = (heads == begin[0]) & first_is_lead
                take = pa.array(heads)
                yield rows({"part": [part] * len(inner), "note": [False] * len(inner), "lead": in_lead, "canon": pc.if_else(pa.array(in_lead), keys.take(take), None), "id": ids.take(pa.array(inner)), "variant": variants.take(pa.array(inner)), "first_id": ids.take(take), "first_variant": variants.take(take), "copies": [None] * len(inner)})
            lead = False
        # the run that is still open
        last = int(begin[-1])
        canon, first, variant, count = keys[last].as_py(), ids[last].as_py(), variants[last].as_py(), 1
        open_rows = n - last - 1
        if open_rows:
            yield rows({"part": [part] * open_rows, "note": [False] * open_rows, "lead": [lead] * open_rows, "canon": [canon if lead else None] * open_rows, "id": ids.slice(last + 1), "variant": variants.slice(last + 1), "first_id": [first] * open_rows, "first_variant": [variant] * open_rows, "copies": [None] * open_rows})
            count += open_rows
    if canon is not None:
        yield rows(note() | {"lead": [True]})


def scan_runs(table: DataFrame, columns: tuple[str, ...], exact: str, id_column: str = "id", runs: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, runs): what the scan found, with runs that cross partitions settled.

    rows: (first_id, id, differs) for every row but the first of its record;
    runs: (first_id, copies) for every record.
    """
    text = F.coalesce
    # as stored: each value with its length, so that no two pairs of values look alike
    variant = F.concat(*[text(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("null,")) for c in columns])
    rows = table.filter(F.col(id_column).isNotNull()).select(canonical(columns, exact).alias("canon"), F.col(id_column).cast("long").alias("id"), variant.alias("variant"))
    width = max(2, shuffle_width(table.sparkSession))
    ordered = rows.repartitionByRange(width, "canon", "id").sortWithinPartitions("canon", "id")
    scanned = ordered.mapInArrow(lambda batches: _scan(batches, runs), _DDL)
    found = materialise(scanned, "runs")
    edges = found.filter("note and lead and canon is not null").groupBy("canon").agg(F.min_by(F.struct("first_id", "first_variant"), F.struct("part", "first_id")).alias("f"), F.sum("copies").alias("total"))
    inside = found.filter("not note and not lead").select("first_id", "id", F.col("variant").eqNullSafe(F.col("first_variant")).alias("alike"))
    # a partition's own first row of a run that began earlier is a copy as well
    own = found.filter("note and lead").select("canon", F.col("first_id").alias("id"), F.col("first_variant").alias("variant"))
    marked = found.filter("not note and lead").select("canon", "id", "variant").unionByName(own)
    # at most two notes for each partition
    settled = marked.join(F.broadcast(edges), "canon").select(F.col("f.first_id").alias("first_id"), "id", F.col("variant").eqNullSafe(F.col("f.first_variant")).alias("alike")).filter("id <> first_id")
    pairs = inside.unionByName(settled).select("first_id", "id", (~F.col("alike")).alias("differs"))
    counted = edges.select(F.col("f.first_id").alias("first_id"), F.col("total").alias("copies")).unionByName(found.filter("note and not lead").select("first_id", "copies"))
    return pairs, counted
