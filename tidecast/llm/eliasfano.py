"""Elias-Fano sequences and an n-gram trie made of them.

A monotone sequence keeps the low bytes of its numbers as they are and the high parts
as a bit vector in unary. All parts are plain arrays over one buffer, so a trie can be
read from a mapped file or from the bytes of a table row without unpacking.
"""

from __future__ import annotations

import mmap
from dataclasses import dataclass

import numpy as np


def _place_in_word(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth (from 0) one in each 64-bit word, by halving."""
    place = np.zeros(len(words), np.uint64)
    left = nth.astype(np.int64).copy()
    for width in (32, 16, 8, 4, 2, 1):
        mask = np.uint64((1 << width) - 1)
        ones = np.bitwise_count((words >> place) & mask).astype(np.int64)
        further = left >= ones
        left = np.where(further, left - ones, left)
        place = np.where(further, place + np.uint64(width), place)
    return place.astype(np.int64)


class EliasFano:
    """A sequence of n non-decreasing numbers below ``universe``."""

    def __init__(self, n: int, universe: int, low: np.ndarray, high: np.ndarray):
        self.n, self.universe, self.low, self.high = n, universe, low, high
        self.shift = 8 * low.shape[1]
        counts = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(counts)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.ascontiguousarray(values, np.uint64)
        n = len(values)
        width = cls.low_bytes(n, universe)
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        high = (values >> np.uint64(8 * width)).astype(np.int64) if width < 8 else np.zeros(n, np.int64)
        size = n + (int(universe) >> (8 * width)) + 2
        bits = np.zeros((size // 64 + 1) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        packed = np.packbits(bits, bitorder="little").view(np.uint64)
        return cls(n, int(universe), np.ascontiguousarray(low), packed)

    @staticmethod
    def low_bytes(n: int, universe: int) -> int:
        """Whole bytes for the low parts: the high bit vector then has at most 2n + 2 bits."""
        per = max(1, int(universe)) // max(1, n)
        return min(8, -(-max(0, per.bit_length() - 1) // 8))

    def _select(self, nth: np.ndarray, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        word = np.searchsorted(before, nth, side="right") - 1
        return word * 64 + _place_in_word(words[word], nth - before[word])

    def lows(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros((len(i), 8), np.uint8)
        out[:, : self.low.shape[1]] = self.low[i]
        return out.view("<u8")[:, 0]

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i."""
        high = (self._select(i, self.ones, self.high) - i).astype(np.uint64)
        return (high << np.uint64(self.shift) if self.shift < 64 else 0 * high) | self.lows(i)

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        high = (at - np.arange(self.n)).astype(np.uint64)
        low = self.lows(np.arange(self.n))
        return (high << np.uint64(self.shift) if self.shift < 64 else 0 * high) | low

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first number >= x (n if none)."""
        x = np.asarray(x, np.uint64)
        high = (x >> np.uint64(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(x), np.int64)
        top = self.universe >> self.shift
        inside = high <= top
        h = np.where(inside, high, 0)
        # Elements whose high part is below h stand before the h-th zero.
        inverse = ~self.high
        first = np.where(h > 0, self._select(np.maximum(h - 1, 0), self.zeros, inverse) - (h - 1), 0)
        last = self._select(h, self.zeros, inverse) - h
        low = x & np.uint64((1 << self.shift) - 1) if self.shift < 64 else x
        a, b = first.copy(), last.copy()
        live = np.flatnonzero(a < b)
        while len(live):
            mid = (a[live] + b[live]) >> 1
            less = self.lows(mid) < low[live]
            a[live] = np.where(less, mid + 1, a[live])
            b[live] = np.where(less, b[live], mid)
            live = live[a[live] < b[live]]
        return np.where(inside, a, self.n)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low.shape[1], len(self.high)], "<i8"), np.array([self.universe], "<u8"), self.low, self.high]

    def tobytes(self) -> bytes:
        return b"".join(p.tobytes() for p in self.parts())

    @classmethod
    def read(cls, buffer, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence at byte ``at`` of a buffer, and where it ends."""
        n, width, words = np.frombuffer(buffer, "<i8", 3, at).tolist()
        universe = int(np.frombuffer(buffer, "<u8", 1, at + 24)[0])
        low = np.frombuffer(buffer, np.uint8, n * width, at + 32).reshape(n, width)
        end = at + 32 + n * width
        high = np.frombuffer(buffer, np.uint64, words, end)
        return cls(n, universe, low, high), end + 8 * words


#: Codes of quantised probabilities: 0 to LEVELS over log10 p from FLOOR to 0.
FLOOR, LEVELS, MISSING = -20.0, 65_534, 65_535


def quantise(log10: np.ndarray) -> np.ndarray:
    scaled = np.clip((log10 - FLOOR) / -FLOOR, 0, 1) * LEVELS
    return np.rint(scaled).astype(np.uint16)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return FLOOR - codes.astype(np.float64) / LEVELS * FLOOR


@dataclass
class Trie:
    """Distinct n-grams of one order by their words' numbers, with a code each.

    Level 1 holds the first words. A node's children are a range of the next level given
    by monotone pointers; there a child is stored as its parent's place times ``words``
    plus its word, which makes the whole level one monotone sequence, and a child is
    found by a successor search relative to its context.
    """

    words: int
    levels: list[EliasFano]
    pointers: list[EliasFano]
    codes: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray, codes: np.ndarray, words: int) -> Trie:
        """``grams``: distinct rows of words in ascending order."""
        n, order = grams.shape
        levels, pointers = [], []
        parent = np.zeros(n, np.int64)  # place of each row's node on the level above
        above = 1
        for k in range(order):
            key = parent.astype(np.uint64) * np.uint64(words) + grams[:, k].astype(np.uint64)
            fresh = np.concatenate([[True], key[1:] != key[:-1]])[:n]
            levels.append(EliasFano.of(key[fresh], above * words))
            if k:
                owner = parent[fresh]
                starts = np.searchsorted(owner, np.arange(above + 1))
                pointers.append(EliasFano.of(starts, len(owner) + 1))
            parent = np.cumsum(fresh) - 1
            above = int(fresh.sum())
        return cls(words, levels, pointers, codes)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Codes of the queried rows, MISSING where there is none."""
        place = np.zeros(len(grams), np.int64)
        alive = np.ones(len(grams), bool)
        for k, level in enumerate(self.levels):
            if not level.n:
                return np.full(len(grams), MISSING, np.uint16)
            key = place.astype(np.uint64) * np.uint64(self.words) + grams[:, k].astype(np.uint64)
            at = level.successor(key)
            if k:
                end = self.pointers[k - 1].get(place + 1).astype(np.int64)
            else:
                end = np.full(len(grams), level.n)
            alive &= at < end
            at = np.where(alive, at, 0)
            alive &= level.get(at) == key
            place = np.where(alive, at, 0)
        return np.where(alive, self.codes[place], MISSING).astype(np.uint16)

    def tobytes(self) -> bytes:
        head = np.array([len(self.levels), self.words, len(self.codes)], "<i8").tobytes()
        body = b"".join(s.tobytes() for s in [*self.levels, *self.pointers])
        return head + body + self.codes.astype("<u2").tobytes()

    @classmethod
    def read(cls, buffer) -> Trie:
        order, words, n = np.frombuffer(buffer, "<i8", 3).tolist()
        at, found = 24, []
        for _ in range(2 * order - 1):
            sequence, at = EliasFano.read(buffer, at)
            found.append(sequence)
        return cls(words, found[:order], found[order:], np.frombuffer(buffer, "<u2", n, at))

    @classmethod
    def mapped(cls, path: str) -> Trie:
        """A trie in a file that ``tobytes`` wrote, mapped into memory."""
        with open(path, "rb") as file:
            return cls.read(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
