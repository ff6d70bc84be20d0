"""Duplicates and near-duplicates of each new batch against all accepted history.

The index stores, for each distinct text, four segments by their length class
and position.  Of four disjoint segments at least one survives up to three
edits unchanged, and, by counting edits from the left, a surviving segment j
exists that has exactly j-1 edits before it and at most 4-j after it.  That
bounds how far its copy can be shifted in the other text, so a new text looks up
44 substrings, for the lengths up to three shorter or longer, and no other.

Segments lie in the last three fifths of a text; the first also takes what
comes before.  Leading parts such as a host name, shared by a great share of all rows,
are so part of a longer segment instead of being a segment themselves.

A segment of more than ``HOT_LEAST`` texts of one append is stored as a mark instead.  What
it leaves open, the rest of the text to its right with at most k-1 edits in it,
or to its left after the last segment, is cut into k pieces under the same
rule, and segment and piece together form a key; a key that is hot again takes
a piece of what is still open.  A look-up that meets a mark is refined alike.  So
no list of hot keys travels anywhere and their number is unbounded.

Keys that hold more than 1 in 2B entries of an append, B being the number of
buckets, would make one task long.  At most 2B such keys exist; look-ups of
these alone are joined with a broadcast of what is stored under them, at most
HOT_LEAST rows and a mark for each append.

The stored tables are bucketed by the column they are joined on, so a batch
never shuffles the history; it shuffles its own look-ups.  Each is read in the
scan of one join, and its texts for candidates alone.

Entries carry a parity bit for each of 40 classes of characters; an edit
changes at most two of them, so pairs that differ in more than six are dropped
before the texts are fetched and verified by a banded edit distance.  Every
hash only routes; what counts was compared as text.

Defined cases: nulls in the text columns count as empty; rows with a null hash,
id or batch are neither cases nor history; texts of any length are handled whole (segments
of very short texts are empty and still match); equal texts share one index
entry; an empty batch or history gives no case; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import Buckets, discard, materialise, ship, shuffle_width

TAU = 3
HOT_LEAST, LEVELS = 128, 8
#: Characters spread at a time; bounds the memory of a task.
LOT_CHARS = 120_000
_N = TAU + 1
_U = np.uint64
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def record_text(columns: tuple[str, ...] = ("domain", "username", "password")) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def _shifts(pieces: int, j: int, delta: int) -> list[int]:
    """Shifts of piece j (from 1) of so many, the other text being longer by delta."""
    return [s for s in range(-(j - 1), j) if abs(delta - s) <= pieces - j]


#: (segment, by how much the looking text is longer, shift) of stored entries and of look-ups.
STORED = np.array([(j, 0, 0) for j in range(1, _N + 1)])
LOOKED_UP = np.array([(j, delta, s) for delta in range(-TAU, TAU + 1) for j in range(1, _N + 1) for s in _shifts(_N, j, delta)])
#: (piece, shift) of a refined key.
PIECES = {False: np.array([(i, 0) for i in range(1, _N + 1)]), True: np.array([(i, t) for i in range(1, _N + 1) for t in range(-(i - 1), i)])}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class _Lot:
    """Some texts as code points, with hashes of any of their substrings."""

    powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def __init__(self, texts: list[str]):
        self.flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        n = len(self.flat)
        if len(self.powers[0]) <= n:
            both = []
            for base in (_BASE, _INVERSE):
                p = np.full(n + 1, base, dtype=np.uint64)
                p[0] = 1
                both.append(np.cumprod(p, dtype=np.uint64))
            type(self).powers = tuple(both)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_mixed(self.flat.astype(np.uint64) + _U(0x9E3779B97F4A7C15)) * self.powers[0][:n], out=self.sums[1:])

    def hashes(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[begin + length] - self.sums[begin]) * self.powers[1][begin]

    def signatures(self) -> np.ndarray:
        """A bit for each class of characters that occurs an odd number of times; ASCII letters and digits have a class each."""
        cls = np.where((self.flat >= 97) & (self.flat < 123), self.flat - 97, np.where((self.flat >= 48) & (self.flat < 58), self.flat - 22, 36 + self.flat % 4)).astype(np.uint64)
        running = np.zeros(len(self.flat) + 1, dtype=np.uint64)
        np.bitwise_xor.accumulate(_U(1) << cls, out=running[1:])
        return running[self.offsets + self.lengths] ^ running[self.offsets]


class _State(NamedTuple):
    """What a key leaves open: a region of the stored text at ``rs``, ``rl`` long, with ``errs`` edits at most.

    In the looking text it begins ``off`` later and is ``change`` longer.  ``at``
    and ``n`` are the place and length of the key's own substring there.
    """

    at: np.ndarray
    n: np.ndarray
    rs: np.ndarray
    rl: np.ndarray
    errs: np.ndarray
    change: np.ndarray
    off: np.ndarray

    def take(self, where) -> _State:
        return _State(*[np.broadcast_to(x, np.broadcast_shapes(*[y.shape for y in self]))[where] for x in self])


def _segment_state(lengths: np.ndarray, j: np.ndarray, delta: np.ndarray, s: np.ndarray) -> _State:
    """Segment j of stored texts ``delta`` shorter than these lengths, shifted by s."""
    size = lengths - delta
    head = size * 2 // 5
    base, more = (size - head) // _N, (size - head) % _N
    own = base + (j + more > _N)
    first, last = j == 1, j == _N
    start = np.where(first, 0, head + (j - 1) * base + np.maximum(0, j - 1 - _N + more))
    n = np.where(first, head + own, own)
    end = start + n
    return _State(start + s, n, np.where(last, 0, end), np.where(last, start, size - end), np.where(last, TAU, _N - j), np.where(last, s, delta - s), np.where(last, 0, s))


def _piece_state(of: _State, i: np.ndarray, t: np.ndarray) -> tuple[_State, np.ndarray]:
    """Piece i, shifted by t, of the open regions; and whether the rule allows it."""
    k = of.errs + 1
    ps, pe = of.rl * (i - 1) // k, of.rl * i // k
    last = i == k
    state = _State(of.rs + of.off + ps + t, pe - ps, np.where(last, of.rs, of.rs + pe), np.where(last, ps, of.rl - pe), np.where(last, i - 1, k - i), np.where(last, t, of.change - t), np.where(last, of.off, of.off + t))
    return state, (i <= k) & (np.abs(t) <= i - 1) & (np.abs(of.change - t) <= k - i)


#: A path tells how a key came about: the way of its segment in the lowest bits, then a piece, plus one, for each refinement.
#: That of a key that leaves nothing open is stored as its complement.
WAY_BITS, PIECE_BITS = 6, 5
IS_OPEN = "path >= 0"


def _inside(lot: _Lot, text: np.ndarray, state: _State) -> np.ndarray:
    return (state.at >= 0) & (state.at + state.n <= lot.lengths[text])


def _segments(lot: _Lot, ways: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, path) of the segments of each text, or of the substrings it looks up."""
    j, delta, s = (ways[:, k : k + 1] for k in range(3))
    lengths = lot.lengths[None, :]
    grid = _segment_state(lengths, j, delta, s)
    # text by text: rows that repeat a text's values lie close together and compress
    text, way = np.nonzero(((lengths >= delta) & _inside(lot, np.arange(len(lot.lengths))[None, :], grid)).T)
    state = grid.take((way, text))
    size = lot.lengths[text] - delta[way, 0]
    key = _mixed(_mixed(lot.hashes(lot.offsets[text] + state.at, state.n)) + _U(0x9E3779B97F4A7C15) * (size * 8 + j[way, 0]).astype(np.uint64))
    return text, key >> _U(16), np.where(state.rl > 0, way, ~way)


def _refined(lot: _Lot, key: np.ndarray, path: np.ndarray, ways: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, path) of each piece of what the keys leave open, text by text."""
    way = path & ((1 << WAY_BITS) - 1)
    state = _segment_state(lot.lengths, *(ways[way, k] for k in range(3)))
    depth = WAY_BITS
    while True:
        piece = (path >> depth) & ((1 << PIECE_BITS) - 1)
        if not piece.any():
            break
        # all rows of a level have the same number of pieces
        state, _ = _piece_state(state, pieces[piece - 1, 0], pieces[piece - 1, 1])
        depth += PIECE_BITS
    i, t = pieces[:, :1], pieces[:, 1:]
    grid, allowed = _piece_state(_State(*[x[None, :] for x in state]), i, t)
    rows = np.arange(len(key))[None, :]
    which, row = np.nonzero(allowed & _inside(lot, rows, grid) & (state.rl > 0)[None, :])
    own = grid.take((which, row))
    new = _mixed(_mixed(lot.hashes(lot.offsets[row] + own.at, own.n)) + _U(0x9E3779B97F4A7C15) * _mixed(key[row] * _U(8) + i[which, 0].astype(np.uint64)))
    longer = path[row] | ((which + 1) << depth)
    return row, new >> _U(16), np.where(own.rl > 0, longer, ~longer)


def _lots(texts: list[str]) -> Iterator[slice]:
    begin = size = 0
    for k, text in enumerate(texts):
        if k > begin and size + len(text) > LOT_CHARS:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


SPREAD = "key long, ref long, sig long, path long"


def _rows(key: np.ndarray, ref: np.ndarray, sig: np.ndarray, path: np.ndarray, only: Callable[[np.ndarray], np.ndarray] | None) -> pa.RecordBatch:
    key = key.view(np.int64)
    columns = [key, ref, sig.view(np.int64), path]
    if only is not None:
        keep = only(key)
        columns = [c[keep] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "ref", "sig", "path"])


def _spread(texts: DataFrame, ref: str, probe: bool, only: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(key, ref, sig, path) of each text of (ref, text) rows."""
    ways = LOOKED_UP if probe else STORED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, held = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for part in _lots(held):
                lot = _Lot(held[part])
                text, key, path = _segments(lot, ways)
                yield _rows(key, refs[part][text], lot.signatures()[text], path, only)

    return texts.select(ref, "text").mapInArrow(run, SPREAD)


def _finer(rows: DataFrame, probe: bool, only: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(key, ref, sig, path) of the pieces of (ref, text, key, path) rows of one level."""
    ways = LOOKED_UP if probe else STORED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, held = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            keys, paths = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(3).to_numpy(zero_copy_only=False)
            for part in _lots(held):
                lot = _Lot(held[part])
                row, key, path = _refined(lot, keys[part], paths[part], ways, PIECES[probe])
                yield _rows(key, refs[part][row], lot.signatures()[row], path, only)

    return rows.select("ref", "text", "key", "path").mapInArrow(run, SPREAD)


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(text, tid, since, h): each distinct text, its least row id, its first batch and its hash."""
    return rows.groupBy("text").agg(F.min("id").alias("tid"), F.min("batch").alias("since")).withColumn("h", F.xxhash64("text"))


class SegmentIndex:
    """The stored index: each batch is looked up and appended, and no more of the history is read than the joins ask for.

    ``add`` expects batches in their order, several at a time if need be; what
    was answered before stays as it is.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, least: int | None = None):
        ship(spark)
        self.spark, self.least, self.buckets = spark, HOT_LEAST if least is None else least, buckets or shuffle_width(spark)
        self.hashes = Buckets(spark, "hashes", "hash", self.buckets)
        self._open()

    def _open(self) -> None:
        #: By level: segments, then what their hot keys were refined to, and so on.
        self.entries = [Buckets(self.spark, f"segments_{k}", "key", self.buckets) for k in range(LEVELS)]
        self.marks = [Buckets(self.spark, f"marks_{k}", "key", self.buckets) for k in range(LEVELS)]
        self.texts = Buckets(self.spark, "texts", "h", self.buckets)
        #: For each level the keys that hold more than 1 in 2 buckets of an append.
        self.heavy: list[set[int]] = [set() for _ in range(LEVELS)]

    def compact(self) -> None:
        """Store all texts anew as if one append had brought them: one file a bucket, and hot keys counted over all."""
        if not self.texts.written:
            return
        old = [*self.entries, *self.marks, self.texts]
        texts = materialise(self.texts.read().groupBy("h", "text").agg(F.min("since").alias("since")), "compacting")
        self._open()
        self.texts.append(texts)
        self._append(texts)
        discard(texts)
        for t in old:
            t.drop()

    def add(self, rows: DataFrame) -> DataFrame:
        """Look (id, batch, hash, text) rows up, append them, and tell (id, exact, since) of each repeat.

        ``since`` is the first batch with the same hash, or with a text at most TAU edits away.
        """
        texts = materialise(distinct_texts(rows), "batch-texts")
        if self.texts.written:
            old = self.texts.read().select(F.col("h").alias("_h"), F.col("text").alias("_text"), F.col("since").alias("old"))
            known = materialise(texts.join(old, texts["h"] == old["_h"]).filter(F.col("text") == F.col("_text")).groupBy("tid").agg(F.min("old").alias("old")), "known")
            held = texts.join(known, "tid", "left")
            # a text that is known from an earlier batch is answered and indexed already
            fresh = materialise(held.filter("old is null or old >= since").select("tid", "h", "text", "since"), "fresh")
        else:
            held, fresh = texts.withColumn("old", F.lit(None).cast("int")), texts
        self.texts.append(fresh.select("h", "text", "since"))
        self._append(fresh)
        near = self._near(fresh)
        first = held.join(near, "tid", "left").select("text", F.least("since", "old", "near").alias("first"))
        by_hash = rows.groupBy("hash").agg(F.min("batch").alias("same"))
        if self.hashes.written:
            earlier = self.hashes.read().select("hash", F.col("since").alias("before"))
            by_hash = by_hash.join(earlier, "hash", "left").groupBy("hash").agg(F.least(F.min("same"), F.min("before")).alias("same"), F.count("before").alias("stored"))
        else:
            by_hash = by_hash.withColumn("stored", F.lit(0))
        by_hash = materialise(by_hash, "batch-hashes")
        judged = rows.join(first, "text").select("id", "batch", "hash", "first").join(by_hash.select("hash", "same"), "hash")
        since = F.least("first", "same")
        out = materialise(judged.filter(F.col("batch") > since).select("id", (F.col("batch") > F.col("same")).alias("exact"), since.alias("since")), "repeats")
        self.hashes.append(by_hash.filter("stored = 0").select("hash", F.col("same").alias("since")))
        discard(texts, by_hash, near, *([] if fresh is texts else [fresh, known]))
        return out

    def _append(self, fresh: DataFrame) -> None:
        """Store the segments of (h, text) rows, as fine as the hot ones among them ask."""
        wide = materialise(_spread(fresh, "h", False), "level-0")
        for entries, marks, heavy in zip(self.entries, self.marks, self.heavy):
            hot = materialise(wide.groupBy("key").count().filter(F.col("count") > self.least), "hot")
            most = hot.agg(F.max("count")).first()[0]
            if entries is self.entries[-1] or most is None:
                entries.append(wide)
                break
            share = wide.count() / (2 * self.buckets)
            if most > share:
                heavy |= {r[0] for r in hot.filter(F.col("count") > F.lit(share)).select("key").collect()}  # at most two for each bucket
            marked = wide.join(hot.select("key", F.lit(True).alias("hot")), "key", "left")
            # a key is marked once, however often it is hot
            new = materialise(hot.select("key").join(marks.read(), "key", "left_anti"), "new-marks") if marks.written else hot.select("key")
            none = F.lit(None).cast("long")
            stored = marked.filter(f"hot is null or not ({IS_OPEN})").drop("hot").select(wide.columns)
            entries.append(stored.unionByName(new.select("key", none.alias("ref"), none.alias("sig"), F.lit(0).cast("long").alias("path"))))
            marks.append(new)
            open_ = wide.filter(IS_OPEN).join(hot.select("key"), "key", "left_semi").withColumnRenamed("ref", "h").select("h", "key", "path")
            with_text = open_.join(fresh.select("h", "text"), "h").select(F.col("h").alias("ref"), "text", "key", "path")
            finer = materialise(_finer(with_text, False), "finer")
            discard(wide, hot)
            wide = finer
        discard(wide)

    def _near(self, fresh: DataFrame) -> DataFrame:
        """(tid, near): the first batch of any stored text at most TAU edits from each of (tid, text) rows."""
        pairs, tables = None, []
        spread: Callable[..., DataFrame] = lambda only=None: _spread(fresh, "tid", True, only)
        for entries, heavy in zip(self.entries, self.heavy):
            if not entries.written:
                break
            met = materialise(self._met(spread, entries, heavy), "met")
            tables.append(met)
            found = met.filter("h is not null").select("h", "tid")
            pairs = found if pairs is None else pairs.unionByName(found)
            if not met.filter("h is null").limit(1).count():
                break
            marks = met.filter("h is null").select("tid", "key", "path").join(fresh.select("tid", "text"), "tid").select(F.col("tid").alias("ref"), "text", "key", "path")
            spread = lambda only=None, marks=marks: _finer(marks, True, only)
        if pairs is None:
            return fresh.select("tid", F.col("since").alias("near")).limit(0)
        stored = self.texts.read().select("h", F.col("text").alias("text_a"), F.col("since").alias("near"))
        both = pairs.distinct().join(stored, "h").join(fresh.select("tid", "text", "since"), "tid").filter("near < since")
        near = materialise(both.filter(F.levenshtein("text_a", "text", TAU) >= 0).groupBy("tid").agg(F.min("near").alias("near")), "near")
        discard(*tables)
        return near

    def _met(self, spread: Callable[..., DataFrame], entries: Buckets, heavy: set[int]) -> DataFrame:
        """(tid, key, path, h): look-ups that meet a stored entry of like characters, or a mark (h null)."""
        stored = entries.read().select("key", F.col("ref").alias("h"), F.col("sig").alias("sig_a"))

        def join(probes: DataFrame, entries: DataFrame) -> DataFrame:
            both = probes.join(entries, "key")
            like = F.bit_count(F.col("sig_a").bitwiseXOR(F.col("sig"))) <= 2 * TAU
            return both.filter((F.col("h").isNull() & F.expr(IS_OPEN)) | like).select(F.col("ref").alias("tid"), "key", "path", "h")

        if not heavy:
            return join(spread(), stored)
        keys = np.array(sorted(heavy), dtype=np.int64)
        few = F.broadcast(stored.filter(F.col("key").isin([int(k) for k in keys])))
        return join(spread(lambda k: ~np.isin(k, keys)), stored).unionByName(join(spread(lambda k: np.isin(k, keys)), few))

    def drop(self) -> None:
        for t in (*self.entries, *self.marks, self.texts, self.hashes):
            t.drop()


def prepared(rows: DataFrame, columns: tuple[str, ...] = ("domain", "username", "password"), hash_column: str = "credential_hash", id_column: str = "id", batch_column: str = "batch_id") -> DataFrame:
    """(id, batch, hash, text) of the rows that count."""
    known = F.col(hash_column).isNotNull() & F.col(id_column).isNotNull() & F.col(batch_column).isNotNull()
    return rows.filter(known).select(F.col(id_column).alias("id"), F.col(batch_column).alias("batch"), F.col(hash_column).alias("hash"), record_text(columns).alias("text"))


def repeats(table: DataFrame, steps: int = 3, **columns) -> DataFrame:
    """(id, exact, since): rows that an earlier batch brought, exactly or nearly.

    The batches go through a SegmentIndex in ``steps`` consecutive ranges of
    about equal size, each looked up in all before it and in itself.
    """
    rows = prepared(table, **columns)
    cuts = rows.agg(F.percentile_approx("batch", [k / steps for k in range(1, steps)])).first()[0] if steps > 1 else []
    edges = [None, *sorted(set(cuts or [])), None]
    index, out = SegmentIndex(table.sparkSession), None
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.filter(F.col("batch") > low)
        if high is not None:
            part = part.filter(F.col("batch") <= high)
        found = index.add(part)
        out = found if out is None else out.unionByName(found)
    return out
