"""Byte-pair encoding of whole texts, each merge found at the root of a segment tree.

A text is cut into pretokens by the vocabulary's pattern.  The adjacent
pairs of a pretoken's bytes are the leaves of a segment tree whose nodes hold the
lowest (rank, position) below.  The root is the leftmost pair of lowest rank;
merging it changes the pair itself and its two neighbours, three point updates
of logarithmic cost, until the root holds no mergeable pair.  So a pretoken of
n bytes costs O(n log n), however long it is.

Pretokens repeat, so each worker remembers the ids of up to CACHE_LIMIT of
them; the memory is emptied when full and longer pretokens are not kept.

Defined cases: null and empty texts have the empty list of ids; blank texts are
encoded as they are; lone surrogates, which UTF-8 lacks, count as U+FFFD; texts
of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.session import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A larger vocabulary file is refused instead of being sent to every task.
VOCABULARY_BYTES = 64 << 20
#: Fixed value: the pretoken pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_LIMIT, CACHED_LENGTH = 400_000, 64
_NONE = 1 << 60


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary's file, which the driver alone needs to reach."""
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}


@lru_cache(maxsize=2)
def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    return ranks_of(read_vocabulary(path))


#: Nodes below a node of the tree.
FAN = 8


class PairTree:
    """Lowest (rank, position) over adjacent pairs, with point updates.

    A leaf holds rank << 32 | position, so the least value is the leftmost of
    the lowest ranks.  A node covers FAN nodes of the level below; the root is
    the least of the top level, which has at most FAN nodes.
    """

    __slots__ = ("levels",)

    def __init__(self, values: list[int]):
        self.levels = levels = [values]
        while len(below := levels[-1]) > FAN:
            levels.append([min(below[k : k + FAN]) for k in range(0, len(below), FAN)])

    def set(self, at: int, value: int) -> None:
        levels = self.levels
        below = levels[0]
        below[at] = value
        for level in levels[1:]:
            at //= FAN
            low = min(below[at * FAN : at * FAN + FAN])
            if level[at] == low:
                return
            level[at] = low
            below = level

    def root(self) -> int:
        return min(self.levels[-1])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pretoken."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    parts: list[bytes] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    leaves = [_NONE if (r := get(piece[i : i + 2])) is None else r << 32 | i for i in range(n - 1)]
    tree = PairTree(leaves)
    put, root = tree.set, tree.root
    while (low := root()) != _NONE:
        i = low & 0xFFFFFFFF
        j = after[i]
        parts[i] += parts[j]
        k = after[i] = after[j]
        parts[j] = b""
        if j < n - 1:
            put(j, _NONE)
        if k < n:
            before[k] = i
            r = get(parts[i] + parts[k])
            put(i, _NONE if r is None else r << 32 | i)
        else:
            put(i, _NONE)
        h = before[i]
        if h >= 0:
            r = get(parts[h] + parts[i])
            put(h, _NONE if r is None else r << 32 | h)
    return [ranks[p] for p in parts if p]


class Encoder:
    """Encodes texts by one vocabulary, remembering pretokens."""

    def __init__(self, vocabulary: bytes):
        import regex

        self.ranks, self.cut, self.known = ranks_of(vocabulary), regex.compile(PATTERN).findall, {}

    def _learn(self, piece: str) -> list[int]:
        ids = merge(piece.encode("utf-8", "replace"), self.ranks)
        if len(piece) <= CACHED_LENGTH:
            if len(self.known) >= CACHE_LIMIT:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get, learn = self.known.get, self._learn
        return list(chain.from_iterable([get(p) or learn(p) for p in self.cut(text)]))


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    """The worker's encoder of a vocabulary, kept between batches and tasks."""
    name = hashlib.sha256(vocabulary).hexdigest()
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def _encode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Callable[[], bytes]) -> Iterator[pa.RecordBatch]:
    enc = encoder(vocabulary())
    for batch in batches:
        ids = [enc.encode(t) for t in batch.column(1).to_pylist()]
        offsets = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in ids], out=offsets[1:])
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(offsets[-1]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["key", "ids"])


def encode_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) for each row: one pass, no shuffle.

    ``vocabulary`` is a file the driver reads; the tasks receive its content.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    out = docs.select(docs[id_column].alias("key"), docs[text_column]).mapInArrow(lambda b: _encode_batches(b, lambda: shared.value), f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", id_column)
