"""The binary Golay code (23, 12, 7) as a fuzzy hash of 23-bit words.

The code is perfect: every 23-bit word has exactly one codeword within distance 3, and the
upper 12 bits of that codeword are the word's *index*. Two words that differ in one bit may
decode to different codewords, but then the codeword of either one is also the codeword of a
neighbour of the other. `nearby_indices` gives the indices of a word and of all its 23
neighbours: one index for words within distance 2 of their codeword, six for the others
(one codeword at distance 3 and five at distance 4). So for words a, b that differ in one bit
at most, the index of a is among the nearby indices of b.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

BITS, INDEX_BITS, NEARBY = 23, 12, 6
GENERATOR = 0b110001110101  # x^11+x^10+x^6+x^5+x^4+x^2+1 divides x^23+1
PARITY_BITS = BITS - INDEX_BITS


def syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of each word, read as a polynomial, divided by the generator."""
    rest = np.array(words, dtype=np.int64)
    for bit in range(BITS - 1, PARITY_BITS - 1, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - PARITY_BITS)), rest)
    return rest


@functools.cache
def _near_errors() -> np.ndarray:
    """For each of the 2,048 syndromes, the error patterns that lead to the nearest codeword
    (column 0) and, where that one is three bits away, to the five codewords four bits away."""
    table = np.full((1 << PARITY_BITS, NEARBY), -1, dtype=np.int64)
    used = np.zeros(1 << PARITY_BITS, dtype=np.int64)
    three_away = np.zeros(1 << PARITY_BITS, dtype=bool)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits)
                             for bits in combinations(range(BITS), weight)], dtype=np.int64)
        found = syndrome(patterns)
        if weight == 3:
            three_away[found] = True
        for s, pattern in zip(found.tolist(), patterns.tolist()):
            if weight < 4 or three_away[s]:
                table[s, used[s]] = pattern
                used[s] += 1
    return np.where(table < 0, table[:, :1], table)  # words near their codeword repeat it


def index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the one codeword within three bits of each word."""
    return (words ^ _near_errors()[syndrome(words), 0]) >> PARITY_BITS


def nearby_indices(words: np.ndarray) -> np.ndarray:
    """Six columns: the indices of each word and its neighbours, the first one repeated where
    there are fewer."""
    return (words[:, None] ^ _near_errors()[syndrome(words)]) >> PARITY_BITS
