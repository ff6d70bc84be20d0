"""Evaluation texts leaking into training texts.

The items' windows of ``n`` words are hashed into a sorted set that every task
receives; the words of the items form a vocabulary.  A document is one scan:
its words become vocabulary numbers (0 for a word no item has), windows with an
unknown word drop out, the rest are hashed and looked up, and each hit is
verified word by word.  Spans can then be cut out, or documents removed.

A set takes some 20 bytes a window.  The set is broadcast only behind a check:
items of more than ``ITEM_LIMIT`` characters are cut into blocks of at most that
size, and ``SETS_A_SCAN`` blocks share a scan of the corpus, so what is broadcast
at a time is bounded whatever the size of the test material, and the answer is the
same whatever the blocks are.

A word is a maximal run of letters and digits in lower case.  Defined cases:
null, empty and short texts, and items of fewer than n words, leak nothing; a
passage that several items hold is reported for each; very long texts are
scanned whole; repeated rows are reported once for each (document, item).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import ship

WORD = re.compile(r"[^\W_]+")
N = 13
ITEM_LIMIT, SETS_A_SCAN = 4_000_000, 4
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[str]:
    """The words in order; as many as WORD finds in the text itself."""
    if not text:
        return []
    low = text.lower()
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


def _mix(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each window of n numbers."""
    m = len(ids) - n + 1
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out *= np.uint64(_BASE)
        out += ids[k : k + m]
    return out


class WindowSet:
    """The n-word windows of some items, for exact lookup, in arrays."""

    def __init__(self, items: list[tuple[int, str]], n: int = N):
        self.n, self.number = n, {}
        flat, owner = [], []
        for k, (_, text) in enumerate(items):
            w = words(text)
            for x in w:
                self.number.setdefault(x, len(self.number) + 1)
            flat += [self.number[x] for x in w]
            owner += [k] * len(w)
        self.ids, self.items = np.array(flat, dtype=np.uint32), [i for i, _ in items]
        of = np.array(owner, dtype=np.int32)
        if len(flat) < n:
            starts = np.zeros(0, np.int64)
        else:
            starts = np.flatnonzero(of[: len(of) - n + 1] == of[n - 1 :])
        hashes = _mix(self.ids, n)[starts] if len(starts) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts = hashes[order], starts[order].astype(np.int32)
        self.owner = of[self.starts]

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(text, first word, item) for each window of a text that an item holds, once for each item."""
        if not len(self.hashes):
            return
        get, n, flat, starts = self.number.get, self.n, [], [0]
        for text in texts:
            flat += [get(w, 0) for w in words(text)]
            flat.append(0)
            starts.append(len(flat))
        ids = np.array(flat, dtype=np.uint32)
        if len(ids) < n:
            return
        # a window counts if the last unknown word lies before it
        unknown = np.where(ids == 0, np.arange(len(ids)), -1)
        last = np.maximum.accumulate(unknown)[n - 1 :]
        begin = np.arange(len(ids) - n + 1)
        begin = begin[last < begin]
        if not len(begin):
            return
        hashes = np.zeros(len(begin), dtype=np.uint64)
        for k in range(n):
            hashes *= np.uint64(_BASE)
            hashes += ids[begin + k]
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        count = high - low
        hit = np.flatnonzero(count)
        if not len(hit):
            return
        # each hit with each window of its hash, verified number by number
        which = np.repeat(hit, count[hit])
        at = np.arange(len(which)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit]) + low[which]
        same = np.ones(len(which), dtype=bool)
        for k in range(n):
            same &= ids[begin[which] + k] == self.ids[self.starts[at] + k]
        found = np.unique(np.stack([begin[which[same]], self.owner[at[same]]], axis=1), axis=0)
        text = np.searchsorted(np.array(starts), found[:, 0], side="right") - 1
        first = found[:, 0] - np.array(starts)[text]
        yield from zip(text.tolist(), first.tolist(), (self.items[k] for k in found[:, 1].tolist()))


def _blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ITEM_LIMIT characters; a longer item stands alone.

    The blocks are made finer until the sums of their lengths fit; only then is one at a time collected.
    """
    texts = items.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // ITEM_LIMIT))
    while True:
        block = F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("long")
        sizes = texts.groupBy(block.alias("b")).agg(F.sum(F.length("text")).alias("chars"), F.count_distinct("id", "text").alias("items"))
        if not sizes.filter((F.col("chars") > ITEM_LIMIT) & (F.col("items") > 1)).limit(1).count():
            break
        n *= 2
    for b in range(n):
        held = [tuple(r) for r in texts.filter(block == b).distinct().collect()]
        if held:
            yield held


def _scans(docs: DataFrame, items: DataFrame, n: int, id_column: str, text_column: str) -> list[list]:
    """Broadcast sets by scan; one empty scan if there is no item."""
    shared = [docs.sparkSession.sparkContext.broadcast(WindowSet(block, n)) for block in _blocks(items, id_column, text_column)]
    return [shared[k : k + SETS_A_SCAN] for k in range(0, len(shared), SETS_A_SCAN)] or [[]]


def leaks(docs: DataFrame, items: DataFrame, n: int = N, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, words_leaked, first_word): each pair with n consecutive words in common."""
    spark, out = docs.sparkSession, None
    ship(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    for sets in _scans(docs, items, n, item_id, text):

        def scan(batches: Iterator[pa.RecordBatch], sets=sets) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), {}
                for t, at, item in chain.from_iterable(shared.value.scan(texts) for shared in sets):
                    found.setdefault((t, item), []).append(at)
                if found:
                    covered = [len({p + k for p in ps for k in range(n)}) for ps in found.values()]
                    yield pa.RecordBatch.from_arrays([pa.array([ids[t] for t, _ in found], pa.int64()), pa.array([i for _, i in found], pa.int64()), pa.array(covered, pa.int64()), pa.array([min(p) for p in found.values()], pa.int64())], names=["doc_id", "item_id", "words_leaked", "first_word"])

        part = rows.mapInArrow(scan, "doc_id long, item_id long, words_leaked long, first_word long")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id", "item_id").agg(F.max("words_leaked").alias("words_leaked"), F.min("first_word").alias("first_word"))


def without_leaks(docs: DataFrame, items: DataFrame, n: int = N, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, text, removed_words): the documents with leaked spans cut out.

    Every scan adds the windows it finds in the whole text; the last
    cuts the spans of all blocks at once, so the blocks do not matter. What
    is left is the text before, between and after the spans, untouched.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("array<long>").alias("starts"))
    scans = _scans(docs, items, n, item_id, text)
    for k, sets in enumerate(scans):
        last = k == len(scans) - 1

        def scan(batches: Iterator[pa.RecordBatch], sets=sets, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                found = {t: set(at) for t, at in enumerate(batch.column(2).to_pylist()) if at}
                for t, at, _ in chain.from_iterable(shared.value.scan(texts) for shared in sets):
                    found.setdefault(t, set()).add(at)
                if not last:
                    starts = pa.array([sorted(found[t]) if t in found else None for t in range(len(texts))], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), starts], names=["doc_id", "text", "starts"])
                    continue
                removed = [0] * len(texts)
                for t, at in found.items():
                    hit = {p + j for p in at for j in range(n)}
                    kept, end = [], 0
                    for w, m in enumerate(WORD.finditer(texts[t])):
                        if w in hit:
                            if w - 1 not in hit:
                                kept.append(texts[t][end : m.start()])
                            end = m.end()
                    texts[t] = "".join(kept) + texts[t][end:]
                    removed[t] = len(hit)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int64())], names=["doc_id", "text", "removed_words"])

        rows = rows.mapInArrow(scan, "doc_id long, text string, removed_words long" if last else "doc_id long, text string, starts array<long>")
    return rows
