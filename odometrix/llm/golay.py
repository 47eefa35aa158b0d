"""The perfect binary Golay code (23, 12, 7), built from its generator.

Every 23-bit word is within 3 bits of exactly one of the 4096 codewords; a
codeword's index is its upper 12 bits. ``nearest`` decodes, ``within4`` lists
the indices of all codewords within 4 bits (5.3 on average).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

# Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rest = np.zeros(4096, "int64")  # remainder of (upper 12 bits << 11)
    for m in range(4096):
        r = m << 11
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GENERATOR << (bit - 11)
        rest[m] = r
    leader = np.zeros(2048, "int64")  # the one error pattern of weight <= 3
    near: list[list[int]] = [[] for _ in range(2048)]  # all of weight <= 4
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            s = int(rest[e >> 11] ^ (e & 0x7FF))
            near[s].append(e)
            if weight <= 3:
                leader[s] = e
    starts = np.cumsum([0] + [len(x) for x in near])
    return rest, leader, starts, np.array([e for x in near for e in x], "int64")


def _syndrome(words: np.ndarray) -> np.ndarray:
    return _tables()[0][words >> 11] ^ (words & 0x7FF)


def nearest(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each word (int64 below 2^23)."""
    return (words ^ _tables()[1][_syndrome(words)]) >> 11


def within4(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, index): one entry per word and codeword within 4 bits of it."""
    _, _, starts, patterns = _tables()
    s = _syndrome(words)
    count = starts[s + 1] - starts[s]
    which = np.repeat(np.arange(len(words)), count)
    ends = np.cumsum(count)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count, count)
    return which, (words[which] ^ patterns[starts[s][which] + place]) >> 11
