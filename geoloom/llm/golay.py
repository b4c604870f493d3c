"""The binary Golay code (23, 12): every 23-bit word lies within 3 bits of exactly one codeword.

``nearby`` gives a word's codewords within 4 bits: one, or six when the nearest is 3 bits
away.  Two words that differ in at most 2 bits always share one of them: a word halfway
between has a codeword within 3 bits, which is within 4 bits of both.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
BITS, CHECK = 23, 11


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder modulo the generator polynomial; 0 for codewords."""
    rest = words.copy()
    for i in range(BITS - 1, CHECK - 1, -1):
        rest ^= np.where((rest >> i) & 1, GENERATOR << (i - CHECK), 0)
    return rest


@cache
def _offsets() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: what to flip to reach each codeword within 4 bits, and how many there are."""
    flips = np.zeros((1 << CHECK, 6), dtype=np.int64)
    count = np.ones(1 << CHECK, dtype=np.int64)
    every = np.arange(1 << BITS, dtype=np.int64)
    code = every[syndrome(every) == 0]
    sevens = code[np.bitwise_count(code) == 7]
    for weight in range(4):
        for bits in combinations(range(BITS), weight):
            error = sum(1 << b for b in bits)
            at = int(syndrome(np.array([error]))[0])
            flips[at, 0] = error
            if weight == 3:
                holding = sevens[(sevens & error) == error]
                flips[at, 1 : 1 + len(holding)] = holding ^ error
                count[at] = 1 + len(holding)
    return flips, count


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``words``, 12-bit index) of every codeword within 4 bits of each word."""
    flips, count = _offsets()
    at = syndrome(words)
    n = count[at]
    rows = np.repeat(np.arange(len(words)), n)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, (words[rows] ^ flips[at[rows], nth]) >> CHECK
