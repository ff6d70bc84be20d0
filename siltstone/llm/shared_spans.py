"""Long exact spans that several documents share.

Searching every document in every shard's index would cost the square of the
corpus, so documents are first routed by content, without losing a span:

1. Exact copies are folded into their least id, by SHA-256.
2. Anchors.  A span of LEAST characters holds LEAST-GRAM+1 consecutive grams
   of GRAM characters; the least of their hashes is an anchor of each document
   that holds the span.  Anchors are hashes with a place, some 24 bytes for
   each 80 characters of text, and only those of two or more documents go on.
3. Shards.  Anchors with the same set of documents (told by count and sums of
   two mixes of the ids) form a group; each document sends its text around these anchors,
   LEAST-GRAM characters on either side, to the group's shard.  If two
   documents share a span, they share an anchor of it, and with it a shard
   where both sent the whole span.  A group too large for one shard is cut into
   blocks, and each pair of blocks is a shard of its own.
4. Each shard builds a compressed FM-index of its texts and searches every
   aligned block of LEAST/2 characters of them backward in its wavelet matrix:
   a span of LEAST characters covers one whole block.  Occurrences
   in other documents are extended to both sides to the full match, verified by
   comparing the texts, and reported if LEAST characters long.

Every hash only routes; what is reported was compared character by character.

Characters are code points.  Defined cases: null texts and texts shorter than
LEAST share nothing; texts of any length are scanned whole; exact copies of at
least LEAST characters share all of it; a span repeated within one document
only is not shared; rows with a null id are left out; rows that repeat id and
text count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.fm_index import FMIndex
from siltstone.session import discard, materialise, shuffle_width

LEAST, GRAM = 320, 160
SHARD_CHARS = 400_000
#: Characters hashed at a time; bounds the memory of a task whatever its texts are.
PIECE_CHARS = 500_000
#: Longest region, overlap aside, that is one row.
REGION_CHARS = 50_000
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, w: int, op, rest: int) -> np.ndarray:
    """op over x[i:i+w] for each i; positions past the end hold ``rest``."""
    n = len(x)
    size = -(-(n + w) // w) * w
    p = np.full(size, rest, dtype=x.dtype)
    p[:n] = x
    blocks = p.reshape(-1, w)
    forward = op.accumulate(blocks, axis=1).ravel()
    backward = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(backward[:n], forward[w - 1 : w - 1 + n])


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and where each text begins."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def gram_hashes(flat: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the gram at each place; the last gram-1 places have none."""
    n = len(flat)
    if n < gram:
        return np.zeros(0, np.uint64)
    letters = _mixed(flat.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(letters * _powers(_BASE, n), out=sums[1:])
    return _mixed((sums[gram:] - sums[:-gram]) * _powers(_INVERSE, n - gram + 1))


def anchors(flat: np.ndarray, bounds: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, first place, last place) of the anchors, neighbours of one hash as one."""
    h = gram_hashes(flat, gram)
    n, w = len(h), least - gram + 1
    none = np.zeros(0, np.int64)
    if not n:
        return none, none.astype(np.uint64), none, none
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    room = bounds[owner + 1] - np.arange(n)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    h = np.where(room >= gram, np.minimum(h, top - np.uint64(1)), top)
    low = np.where(room >= least, _sliding(h, w, np.minimum, int(top)), np.uint64(0))
    # the greatest minimum over the windows that hold a place: itself, if it is an anchor
    high = _sliding(low[::-1], w, np.maximum, 0)[::-1]
    at = np.flatnonzero((high == h) & (room >= gram))
    if not len(at):
        return none, none.astype(np.uint64), none, none
    new = np.ones(len(at), bool)
    new[1:] = (h[at[1:]] != h[at[:-1]]) | (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    text = owner[at[begin]]
    return text, h[at[begin]], at[begin] - bounds[text], at[end] - bounds[text]


def _pieces(texts: list[str], overlap: int) -> Iterator[list[tuple[int, int, str]]]:
    """(text, offset, piece) in lots of at most about PIECE_CHARS characters.

    A longer text is cut into pieces that overlap by ``overlap`` characters, so
    every window of one more lies whole in one of them.
    """
    lot, size = [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - overlap), PIECE_CHARS - overlap):
            piece = text[at : at + PIECE_CHARS]
            if lot and size + len(piece) > PIECE_CHARS:
                yield lot
                lot, size = [], 0
            lot.append((k, at, piece))
            size += len(piece)
    if lot:
        yield lot


def _anchor_batches(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lot in _pieces(batch.column(1).to_pylist(), least - 1):
            text, h, first, last = anchors(*code_points([p for _, _, p in lot]), least, gram)
            owner, offset = np.array([k for k, _, _ in lot])[text], np.array([at for _, at, _ in lot])[text]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[owner].astype(np.int64)), pa.array((first + offset).astype(np.int32)), pa.array((last + offset).astype(np.int32))], names=["h", "doc", "first", "last"])


def _regions(batches: Iterator[pa.RecordBatch], margin: int, gram: int, least: int) -> Iterator[pa.RecordBatch]:
    """Cut each document's text around the anchors of each group; overlapping windows are one.

    A long region goes on in pieces that overlap, so every span of ``least`` characters lies whole in one of them.
    """
    for batch in batches:
        out: dict[str, list] = {"grp": [], "doc": [], "start": [], "part": []}
        for doc, text, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            spans: dict[int, list[list[int]]] = {}
            for m in sorted(marks, key=lambda m: m["first"]):
                a, b = max(0, m["first"] - margin), min(len(text), m["last"] + gram + margin)
                held = spans.setdefault(m["grp"], [])
                if held and a <= held[-1][1]:
                    held[-1][1] = max(held[-1][1], b)
                else:
                    held.append([a, b])
            for grp, held in spans.items():
                for a, b in held:
                    for at in range(a, max(a + 1, b - least + 1), REGION_CHARS):
                        out["grp"].append(grp)
                        out["doc"].append(doc)
                        out["start"].append(at)
                        out["part"].append(text[at : min(b, at + REGION_CHARS + least - 1)])
        yield pa.RecordBatch.from_arrays([pa.array(out["grp"], pa.int64()), pa.array(out["doc"], pa.int64()), pa.array(out["start"], pa.int32()), pa.array(out["part"], pa.string())], names=["grp", "doc", "start", "part"])


Region = tuple[int, int, str]
_COLUMNS = ("doc_a", "start_a", "doc_b", "start_b", "length")


def _matches(indexed: list[Region], asked: list[Region], least: int) -> list[np.ndarray]:
    """The columns (doc_a, start_a, doc_b, start_b, length) of the maximal matches between two lists of (doc, start, text).

    If both are the same list, each pair comes out once.
    """
    same = indexed is asked
    flat, bounds = code_points([t for _, _, t in indexed])
    letters, coded = np.unique(flat, return_inverse=True)
    # 0 ends the text, 1 separates its parts
    text = np.insert(coded.astype(np.int64) + 2, bounds[1:], 1)
    text = np.append(text, 0)
    begins = bounds + np.arange(len(bounds))
    index = FMIndex(text)
    block = least // 2
    if same:
        other, other_begins = text, begins
    else:
        q_flat, q_bounds = code_points([t for _, _, t in asked])
        at = np.searchsorted(letters, q_flat)
        at[at == len(letters)] = 0
        other = np.append(np.insert(np.where(letters[at] == q_flat, at + 2, -1), q_bounds[1:], -2), -3)
        other_begins = q_bounds + np.arange(len(q_bounds))
    sizes = np.diff(other_begins) - 1
    starts = np.concatenate([[0], *[np.arange(b, b + s - block + 1, block) for b, s in zip(other_begins[:-1], sizes)]]).astype(np.int64)[1:]
    which, low, high = index.search(other, starts, block, 2 if same else 1)
    i_doc, i_start = (np.array([r[k] for r in indexed], dtype=np.int64) for k in (0, 1))
    q_doc, q_start = (np.array([r[k] for r in asked], dtype=np.int64) for k in (0, 1))
    out: list[list[np.ndarray]] = [[] for _ in _COLUMNS]
    counts = high - low
    # hits are expanded a bounded number at a time
    edge, total = 0, np.cumsum(counts)
    while edge < len(which):
        to = max(edge + 1, int(np.searchsorted(total, (total[edge - 1] if edge else 0) + 100_000, side="right")))
        w, lo, c = which[edge:to], low[edge:to], counts[edge:to]
        edge = to
        inside = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        x = index.locate(np.repeat(lo, c) + inside)
        p = starts[np.repeat(w, c)]
        xr = np.searchsorted(begins, x, side="right") - 1
        pr = np.searchsorted(other_begins, p, side="right") - 1
        keep = np.flatnonzero(q_doc[pr] < i_doc[xr] if same else q_doc[pr] != i_doc[xr])
        x, p, xr, pr = x[keep], p[keep], xr[keep], pr[keep]
        # a match that goes back a whole block was found from that block already
        left = _extend(text, other, x - 1, p - 1, -1, block)
        keep = np.flatnonzero(left < block)
        x, p, xr, pr, left = x[keep], p[keep], xr[keep], pr[keep], left[keep]
        right = _extend(text, other, x + block, p + block, 1)
        length = left + block + right
        keep = np.flatnonzero(length >= least)
        x, p, xr, pr, left, length = (v[keep] for v in (x, p, xr, pr, left, length))
        d1, s1 = q_doc[pr], q_start[pr] + p - left - other_begins[pr]
        d2, s2 = i_doc[xr], i_start[xr] + x - left - begins[xr]
        turn = d1 > d2
        for held, v in zip(out, (np.where(turn, d2, d1), np.where(turn, s2, s1), np.where(turn, d1, d2), np.where(turn, s1, s2), length)):
            held.append(v)
    return [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out]


def _extend(text: np.ndarray, other: np.ndarray, x: np.ndarray, p: np.ndarray, way: int, enough: int = 1 << 62) -> np.ndarray:
    """How many characters agree from x in text and p in other, going either way, at least up to ``enough``.

    The characters themselves are compared, in strides, up to the first
    difference; separators (1, and below 0) agree with nothing.
    """
    out = np.zeros(len(x), dtype=np.int64)
    # most pairs differ at once; those that do not take wider strides
    live, stride = np.arange(len(x)), 4
    while len(live):
        steps = np.arange(stride) * way
        a, b = (x[live] + out[live] * way)[:, None] + steps, (p[live] + out[live] * way)[:, None] + steps
        fit = (a >= 0) & (a < len(text)) & (b >= 0) & (b < len(other))
        va, vb = text[np.clip(a, 0, len(text) - 1)], other[np.clip(b, 0, len(other) - 1)]
        agree = fit & (va == vb) & (va > 1)
        run = np.where(agree.all(axis=1), stride, agree.argmin(axis=1))
        out[live] += run
        live = live[(run == stride) & (out[live] < enough)]
        stride = 32
    return out


def _match_shard(least: int):
    def run(table: pa.Table) -> pa.Table:
        rows: dict[bool, list[Region]] = {False: [], True: []}
        for asking, doc, start, part in zip(table["asking"].to_pylist(), table["doc"].to_pylist(), table["start"].to_pylist(), table["part"].to_pylist()):
            rows[asking].append((doc, start, part))
        found = _matches(rows[False], rows[True] or rows[False], least) if rows[False] else [np.zeros(0, np.int64)] * 5
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(_COLUMNS, found)})

    return run


def folded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST) -> DataFrame:
    """(doc, rep): each document of at least ``least`` characters with the least id of its text."""
    rows = docs.filter(F.col(id_column).isNotNull() & (F.length(text_column) >= least)).select(F.col(id_column).alias("doc"), F.unhex(F.sha2(text_column, 256)).alias("digest"))
    reps = rows.groupBy("digest").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("n"))
    # copies alone are joined back; every other document is its own representative
    copied = rows.join(reps.filter("n > 1").select("digest", "rep"), "digest").select("doc", "rep").distinct()
    return copied


def _united(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The intervals of each document, those that touch or overlap as one."""
    if not len(doc):
        return doc, begin, end
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    # per document the furthest end so far; documents are kept apart by a shift
    shift = (np.cumsum(np.concatenate([[0], np.diff(doc) != 0])) * (int(end.max()) + 1)).astype(np.int64)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (begin + shift)[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return doc[at], begin[at], (reach - shift)[np.append(at[1:], len(doc)) - 1]


def _covered_shard(least: int):
    """What of each region another document of the shard has, as united intervals: no more rows than regions have text."""

    def run(table: pa.Table) -> pa.Table:
        regions = list(zip(table["doc"].to_pylist(), table["start"].to_pylist(), table["part"].to_pylist()))
        doc_a, start_a, doc_b, start_b, length = _matches(regions, regions, least)
        doc, begin, end = _united(np.concatenate([doc_a, doc_b]), np.concatenate([start_a, start_b]), np.concatenate([start_a + length, start_b + length]))
        return pa.table({"doc": pa.array(doc, pa.int64()), "a": pa.array(begin, pa.int64()), "b": pa.array(end, pa.int64())})

    return run


def _gram_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(grp, h, k, doc, at) of every place of the regions where ``least`` characters begin."""
    for batch in batches:
        grp, doc, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        for lot in _pieces(batch.column(3).to_pylist(), least - 1):
            flat, bounds = code_points([p for _, _, p in lot])
            # two hashes of unlike letters, 128 bits together
            h, k = gram_hashes(flat, least), gram_hashes(flat + np.uint32(0x10000000), least)
            owner = np.repeat(np.arange(len(lot)), np.diff(bounds))[: len(h)]
            fits = np.flatnonzero(bounds[owner + 1] - np.arange(len(h)) >= least)
            row, offset = np.array([r for r, _, _ in lot])[owner[fits]], np.array([at for _, at, _ in lot])[owner[fits]]
            yield pa.RecordBatch.from_arrays([pa.array(grp[row]), pa.array(h[fits].view(np.int64)), pa.array(k[fits].view(np.int64)), pa.array(doc[row]), pa.array(start[row].astype(np.int64) + offset + fits - bounds[owner[fits]])], names=["grp", "h", "k", "doc", "at"])


class Shards(NamedTuple):
    """Text regions by shard, those of groups too large for one, and exact copies."""

    small: DataFrame
    large: DataFrame
    copies: DataFrame


def shards(docs: DataFrame, id_column: str, text_column: str, least: int, gram: int, shard_chars: int) -> Shards:
    """small: (shard, doc, start, part); large: (grp, blocks, doc, start, part); copies: (doc, rep) of every document whose text another one has as well."""
    long = docs.filter(F.col(id_column).isNotNull() & (F.length(text_column) >= least)).select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    copies = materialise(folded(docs, id_column, text_column, least), "copies")
    extra = copies.filter("doc <> rep").select("doc")
    marks = long.mapInArrow(lambda b: _anchor_batches(b, least, gram), "h long, doc long, first int, last int")
    marks = materialise(marks.join(extra, "doc", "left_anti"), "anchors")
    sets = marks.select("h", "doc").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("y")).filter("n > 1").select("h", F.xxhash64("n", "x", "y").alias("grp"))
    wanted = marks.join(sets, "h").groupBy("doc").agg(F.collect_list(F.struct("grp", "first", "last")).alias("marks"))
    # a document's marks are bounded by its own length
    parts = long.join(wanted, "doc").select("doc", "text", "marks").mapInArrow(lambda b: _regions(b, least - gram, gram, least), "grp long, doc long, start int, part string")
    parts = materialise(parts, "regions")
    discard(marks)
    sizes = parts.groupBy("grp").agg(F.sum(F.length("part")).alias("chars"))
    total = sizes.agg(F.sum("chars")).first()[0] or 0
    n = max(shuffle_width(docs.sparkSession), -(-total // shard_chars))
    large = sizes.filter(F.col("chars") > 2 * shard_chars).select("grp", F.ceil(F.col("chars") / shard_chars).cast("int").alias("blocks"))
    placed = parts.join(large, "grp", "left")
    small = placed.filter("blocks is null").select(F.pmod("grp", F.lit(n)).cast("long").alias("shard"), "doc", "start", "part")
    return Shards(small, placed.filter("blocks is not null").select("grp", "blocks", "doc", "start", "part"), copies)


def span_matches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, gram: int = GRAM, shard_chars: int = SHARD_CHARS) -> tuple[DataFrame, DataFrame]:
    """(matches, copies): maximal shared spans between different texts, and exact copies.

    matches: (doc_a, start_a, doc_b, start_b, length) between representatives, doc_a < doc_b.
    copies: (doc, rep) of every document whose text another one has as well.
    """
    s = shards(docs, id_column, text_column, least, gram, shard_chars)
    small = s.small.select("shard", F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(False).alias("asking"), "doc", "start", "part")
    # block b is indexed in the shards (b, b..) and asks in the shards (..b, b)
    cut = s.large.withColumn("b", F.pmod(F.xxhash64("doc", "start"), F.col("blocks")).cast("int"))
    index = cut.select(F.col("grp").alias("shard"), F.col("b").alias("i"), F.explode(F.sequence("b", F.col("blocks") - 1)).alias("j"), F.lit(False).alias("asking"), "doc", "start", "part")
    asks = cut.select(F.col("grp").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("b"))).alias("i"), F.col("b").alias("j"), F.lit(True).alias("asking"), "doc", "start", "part").filter("i < j")
    matches = small.unionByName(index).unionByName(asks).groupBy("shard", "i", "j").applyInArrow(_match_shard(least), "doc_a long, start_a long, doc_b long, start_b long, length long")
    return materialise(matches, "matches"), s.copies


def covered_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, gram: int = GRAM, shard_chars: int = SHARD_CHARS) -> tuple[DataFrame, DataFrame]:
    """(spans, copies): (doc, a, b) of what each representative shares with any other, unions not yet taken, and exact copies.

    No pair of documents is formed.  A shard's index tells what its regions
    share.  In groups too large for a shard every place of the regions is hashed
    with the ``least`` characters from it on, and a place is covered if two
    documents have its hash: work and output in proportion to the text.
    """
    s = shards(docs, id_column, text_column, least, gram, shard_chars)
    within = s.small.groupBy("shard").applyInArrow(_covered_shard(least), "doc long, a long, b long")
    places = s.large.select("grp", "doc", "start", "part").mapInArrow(lambda b: _gram_batches(b, least), "grp long, h long, k long, doc long, at long")
    shared = places.groupBy("grp", "h", "k").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("grp", "h", "k")
    across = places.join(shared.hint("merge"), ["grp", "h", "k"]).select("doc", F.col("at").alias("a"), (F.col("at") + least).alias("b")).distinct()
    return materialise(within.unionByName(across), "covered"), s.copies


def sharing_pairs(docs: DataFrame, least: int = LEAST, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(doc_id_a, doc_id_b): documents with a span of at least ``least`` characters in common, copies expanded."""
    matches, copies = span_matches(docs, least=least, shard_chars=shard_chars)
    near = matches.select("doc_a", "doc_b").distinct()
    members = copies.select(F.col("rep"), F.col("doc"))

    def expand(pairs: DataFrame, side: str) -> DataFrame:
        """Each side's copies in its place; a text without copies stands for itself."""
        m = members.select(F.col("rep").alias(side), F.col("doc").alias("_other"))
        return pairs.join(m, side, "left").withColumn(side, F.coalesce("_other", side)).drop("_other")

    across = expand(expand(near, "doc_a"), "doc_b")
    within = members.select("rep", F.col("doc").alias("doc_a")).join(members.select("rep", F.col("doc").alias("doc_b")), "rep").filter("doc_a < doc_b").select("doc_a", "doc_b")
    both = across.unionByName(within)
    return both.select(F.least("doc_a", "doc_b").alias("doc_id_a"), F.greatest("doc_a", "doc_b").alias("doc_id_b")).distinct()


def shared_share(docs: DataFrame, least: int = LEAST, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share, spans) for each document that shares a span."""
    sides, copies = covered_spans(docs, least=least, shard_chars=shard_chars)
    sides = sides.distinct()
    # a document's intervals, united in order of their begin
    w = Window.partitionBy("doc").orderBy("a", "b")
    reach = sides.withColumn("reach", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    covered = reach.groupBy("doc").agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce("reach", "a")))).alias("covered"), F.count_if(F.col("reach").isNull() | (F.col("a") > F.col("reach"))).alias("spans"))
    long = docs.filter(F.col("doc_id").isNotNull() & (F.length("text") >= least)).select("doc_id", F.length("text").cast("long").alias("n_chars")).distinct()
    out = long.join(covered.withColumnRenamed("doc", "doc_id"), "doc_id", "left").join(copies.select(F.col("doc").alias("doc_id"), F.lit(True).alias("copied")), "doc_id", "left")
    out = out.filter("covered is not null or copied")
    shared = F.when(F.col("copied"), F.col("n_chars")).otherwise(F.col("covered"))
    return out.select("doc_id", "n_chars", shared.alias("shared_chars"), F.round(shared / F.col("n_chars"), 4).alias("share"), F.when(F.col("copied"), F.lit(1)).otherwise(F.col("spans")).cast("long").alias("spans"))
