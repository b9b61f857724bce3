"""A compressed FM-index in numpy: wavelet matrix over the transform, batched backward search."""

from __future__ import annotations

import numpy as np


class BitRank:
    """A bit string with constant-time rank: 64-bit words and a running count for each."""

    def __init__(self, bits: np.ndarray):
        pad = np.zeros(-len(bits) % 64 + 64, np.uint8)
        self.words = np.packbits(np.concatenate([bits.astype(np.uint8), pad]), bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.uint32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Counts the occurrences of patterns of up to ``depth`` symbols in a text of small integers.

    Suffixes are ordered by their first 2^ceil(log2(depth)) symbols only, which leaves every
    interval of a pattern of at most ``depth`` symbols, and so backward search, exact.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, reach = text.astype(np.int64), 1
        while reach < depth:
            ahead = np.zeros(n, np.int64)
            ahead[: n - reach] = rank[reach:] + 1 if n > reach else 0
            rank = np.unique(rank * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1].astype(np.int64)
            reach *= 2
        order = np.argsort(rank, kind="stable")
        turned = text[order - 1].astype(np.int64)  # the symbol before each suffix
        top = int(text.max(initial=0))
        self.n = n
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.levels, self.zeros = [], []
        bits = max(1, top.bit_length())
        order, swapped = np.arange(top + 1), np.zeros(top + 1, np.int64)
        for b in range(bits):
            swapped |= ((order >> b) & 1) << (bits - 1 - b)
        order = np.argsort(swapped)  # how the last level lays out the symbols
        counts = np.diff(self.first)
        self.base = np.empty(top + 1, np.int64)
        self.base[order] = np.cumsum(counts[order]) - counts[order]
        for bit in reversed(range(bits)):
            ones = (turned >> bit) & 1
            self.levels.append((bit, BitRank(ones)))
            self.zeros.append(int(n - ones.sum()))
            turned = np.concatenate([turned[ones == 0], turned[ones == 1]])

    def step(self, symbol: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern, from the intervals of the patterns."""
        lo, hi = left, right
        for (bit, level), zeros in zip(self.levels, self.zeros, strict=True):
            one = ((symbol >> bit) & 1).astype(bool)
            lo1, hi1 = level.rank(lo), level.rank(hi)
            lo = np.where(one, zeros + lo1, lo - lo1)
            hi = np.where(one, zeros + hi1, hi - hi1)
        start = self.first[symbol] - self.base[symbol]
        return start + lo, start + hi

    def matching(self, patterns: np.ndarray, times: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics at the end of each pattern (a row of symbols).

        How many of its last symbols, at most all, occur together ``times`` times and more in
        the text, and their interval of suffixes. A pattern is left as soon as one more symbol
        would take its interval below that.
        """
        last = patterns[:, -1]
        left, right = self.first[last], self.first[last + 1]
        length = (right - left >= times).astype(np.int64)
        alive = np.flatnonzero(length)
        for j in reversed(range(patterns.shape[1] - 1)):
            lo, hi = self.step(patterns[alive, j], left[alive], right[alive])
            more = hi - lo >= times
            alive = alive[more]
            left[alive], right[alive] = lo[more], hi[more]
            length[alive] += 1
        return length, left, right
