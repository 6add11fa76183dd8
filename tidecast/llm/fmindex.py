"""An FM-index over whole numbers, in numpy.

The text is runs of symbols 1 and up, parted by symbol 0, which no phrase holds. Zeros
are told apart by their place, so suffixes are compared up to the end of their run only.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start places of all suffixes in order, by doubling the compared length.

    A suffix's rank is the number of suffixes that are smaller by what was compared, so
    suffixes that still tie share a rank; only those are sorted again.
    """
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    value = text.astype(np.int64) + len(zeros)
    value[zeros] = np.arange(len(zeros))
    order = np.argsort(value, kind="stable")
    sorted_values = value[order]
    heads = np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])[:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0)) if n else 0
    tied = order[~_alone(heads)]
    step = 1
    while len(tied):
        behind = tied + step
        following = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        by = np.lexsort((following, rank[tied]))
        places, r, f = tied[by], rank[tied][by], following[by]
        group = np.concatenate([[True], r[1:] != r[:-1]])
        heads = group | np.concatenate([[True], f[1:] != f[:-1]])
        at = np.arange(len(places))
        first = np.maximum.accumulate(np.where(group, at, 0))
        start = np.maximum.accumulate(np.where(heads, at, 0))
        rank[places] = r + (start - first)
        tied = places[~_alone(heads)]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _alone(heads: np.ndarray) -> np.ndarray:
    """Whether each head is followed by another head: a group of one."""
    return heads & np.concatenate([heads[1:], [True]])[: len(heads)]


class Bits:
    """A bit vector with constant-time counts: packed words and counts before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)).astype(np.int64) & 1


class Wavelet:
    """Wavelet tree, its levels stored one after another: rank and access."""

    def __init__(self, text: np.ndarray, top: int):
        self.levels: list[tuple[Bits, int]] = []
        self.depth = max(1, int(top).bit_length())
        for level in range(self.depth - 1, -1, -1):
            bits = (text >> level) & 1
            self.levels.append((Bits(bits), int(len(bits) - bits.sum())))
            text = np.concatenate([text[bits == 0], text[bits == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place i."""
        start = np.zeros_like(i)
        for level, (bits, zeros) in zip(range(self.depth - 1, -1, -1), self.levels):
            one = (symbol >> level) & 1
            a, b = bits.ones(start), bits.ones(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for bits, zeros in self.levels:
            one, a = bits.at(i), bits.ones(i)
            symbol = symbol << 1 | one
            i = np.where(one == 1, zeros + a, i - a)
        return symbol


class Index:
    """Backward search for phrases and their places, over runs parted by zeros.

    Places are kept for every ``sample``-th of the text and for run starts; others are
    reached by stepping back through the text.
    """

    def __init__(self, text: np.ndarray, sample: int = 16):
        text = np.asarray(text, np.int64)
        self.size = len(text)
        order = suffix_order(text)
        last = text[order - 1] if self.size else text
        top = int(text.max()) if self.size else 0
        self.top = top
        self.tree = Wavelet(last, top)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        kept = (order % sample == 0) | (last == 0)
        self.kept = Bits(kept.astype(np.uint8))
        self.places = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase; phrases are rows padded behind their length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for step in range(int(lengths.max()) if len(lengths) else 0):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step]
            known = (symbol > 0) & (symbol <= self.top)
            low[live[~known]] = high[live[~known]] = 0
            live, symbol = live[known], symbol[known]
            base = self.starts[symbol]
            low[live] = base + self.tree.rank(symbol, low[live])
            high[live] = base + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows, by steps back to a kept one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(self.kept.at(rows) == 0)
        while len(open_):
            at = rows[open_]
            symbol = self.tree.access(at)
            rows[open_] = self.starts[symbol] + self.tree.rank(symbol, at)
            steps[open_] += 1
            open_ = open_[self.kept.at(rows[open_]) == 0]
        return self.places[self.kept.ones(rows)] + steps
