"""A compressed full-text index over numpy arrays: BWT in a wavelet matrix.

Bit vectors are packed 64 to a word with one running count a word, so the index
takes about 1.5 bits a level and character.  Of the suffix array every RATEth
place of the text is kept, with a bit for each row that has one; a hit is located
by going back through the text from row to row until such a place is met.  All
patterns of a batch are searched backward together, all hits located together.
"""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ``codes`` ends with a unique least symbol.

    The first ranks compare as many symbols as fit into 62 bits.
    """
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    k = max(1, min(62 // bits, 16))
    key = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(k, np.int64)])
    for i in range(k):
        key = (key << bits) | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, dtype=np.int64)
        steps = np.empty(n, dtype=np.int64)
        steps[0] = 0
        np.cumsum(ordered[1:] != ordered[:-1], out=steps[1:])
        new[order] = steps
        if steps[-1] == n - 1 or k >= n:
            return order
        second = np.zeros(n, dtype=np.int64)
        second[: n - k] = new[k:] + 1
        key = new * (n + 1) + second
        k *= 2


#: Distance of the text places whose rows are kept.
RATE = 8


class BitVector:
    """Packed bits with rank."""

    __slots__ = ("before", "words", "zeros")

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, dtype=np.uint8)
        raw = np.packbits(bits, bitorder="little")
        packed[: len(raw)] = raw
        self.words = packed.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)
        self.zeros = n - int(ones.sum())

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    """Backward search over a text of small codes; code 0 is the end, 1 separates parts."""

    def __init__(self, codes: np.ndarray):
        self.n = n = len(codes)
        sa = suffix_array(codes)
        bwt = codes[sa - 1]
        kept = sa % RATE == 0
        self.has_place, self.places = BitVector(kept.astype(np.uint8)), sa[kept].astype(np.int32)
        del sa
        top = int(codes.max())
        self.levels = max(1, top.bit_length())
        counts = np.bincount(codes, minlength=(1 << self.levels) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.bits: list[BitVector] = []
        begin = np.zeros(1 << self.levels, dtype=np.int64)
        symbols, current = np.arange(1 << self.levels), bwt
        for level in range(self.levels):
            shift = self.levels - 1 - level
            bit = (current >> shift) & 1
            v = BitVector(bit.astype(np.uint8))
            self.bits.append(v)
            up = ((symbols >> shift) & 1).astype(bool)
            ones = v.rank(begin)
            begin = np.where(up, v.zeros + ones, begin - ones)
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        self.begin = begin

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position of the BWT."""
        for level, v in enumerate(self.bits):
            ones = v.rank(i)
            up = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            i = np.where(up, v.zeros + ones, i - ones)
        return i - self.begin[symbol]

    def _back(self, row: np.ndarray) -> np.ndarray:
        """The row of the text place before that of each row."""
        symbol, i = np.zeros(len(row), np.int64), row
        for v in self.bits:
            up, ones = v.get(i), v.rank(i)
            i = np.where(up, v.zeros + ones, i - ones)
            symbol = (symbol << 1) | up
        return self.first[symbol] + i - self.begin[symbol]

    def locate(self, row: np.ndarray) -> np.ndarray:
        """The text place of each row."""
        out, live, row, gone = np.zeros(len(row), np.int64), np.arange(len(row)), row.copy(), 0
        while len(live):
            met = self.has_place.get(row)
            out[live[met]] = self.places[self.has_place.rank(row[met])] + gone
            live, row, gone = live[~met], self._back(row[~met]), gone + 1
        return out

    def search(self, text: np.ndarray, starts: np.ndarray, length: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, low, high) for the patterns text[start:start+length] with ``least`` or more occurrences.

        Codes that the index lacks are given as -1.
        """
        which = np.arange(len(starts))
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for step in range(length - 1, -1, -1):
            if not len(which):
                break
            c = text[starts[which] + step]
            known = c >= 0
            if not known.all():
                which, low, high, c = which[known], low[known], high[known], c[known]
            m = len(which)
            both = self.rank(np.concatenate([c, c]), np.concatenate([low, high])) + np.concatenate([self.first[c]] * 2)
            low, high = both[:m], both[m:]
            live = high - low >= least
            if not live.all():
                which, low, high = which[live], low[live], high[live]
        return which, low, high
