"""The perfect binary Golay code of length 23, vectorised.

Every 23-bit word lies within 3 bits of exactly one codeword. A word's keys are the
codewords nearest to it and to its 23 one-bit neighbours: one key if the word is within
2 bits of its codeword, else six. Two words at most 2 bits apart have a common word one
bit from both (or are neighbours), so they share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH = 23
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    remainders = np.array([_remainder(m << 11) for m in range(1 << 12)], np.int64)
    errors = np.zeros(1 << 11, np.int64)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            errors[remainders[error >> 11] ^ (error & 0x7FF)] = error
    return remainders, errors


REMAINDERS, ERRORS = _tables()
FLIPS = np.array([0, *(1 << b for b in range(LENGTH))], np.int64)


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within 3 bits of each word."""
    syndrome = REMAINDERS[words >> 11] ^ (words & 0x7FF)
    return (words ^ ERRORS[syndrome]) >> 11


def keys(words: np.ndarray) -> np.ndarray:
    """Per word its sorted keys in 6 columns; -1 where there are fewer."""
    found = np.sort(nearest(words[:, None] ^ FLIPS), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    out = np.full((len(words), 6), -1, np.int64)
    row, column = np.nonzero(fresh)
    place = np.cumsum(fresh, axis=1)[row, column] - 1
    out[row, place] = found[row, column]
    return out
