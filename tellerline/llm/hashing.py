"""Vectorised hashes of words and n-grams in UTF-8 bytes.

A polynomial prefix hash over a block of bytes gives the hash of any span from
two look-ups, so words, word pairs and character n-grams of a whole block are
hashed without a Python loop.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xD6E8FEB86659FD93)
PAIR = np.uint64(0xA0761D6478BD642F)

#: What a byte is: 0 white space, 1 letter (or part of one beyond ASCII), 2 digit, 3 other.
KIND = np.full(256, 3, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = 0
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = KIND[128:] = 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _tables.get(base)
    if known is None or len(known) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        known = _tables[base] = np.multiply.accumulate(grown)
    return known[:n]


def mixed(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(32))) * MIX


class Spans:
    """Hashes of spans of one block, letters of ASCII in lower case unless told otherwise."""

    def __init__(self, data: np.ndarray, lower: bool = True):
        self.data = LOWER[data] if lower else data
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), out=sums[1:])
        self.sums = sums
        self.shift = _powers(INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.shift[starts])

    def grams(self, n: int) -> np.ndarray:
        """The hash of the ``n`` bytes from each position that has as many after it."""
        m = len(self.data) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[n:] - self.sums[:m]) * self.shift[:m])


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows (positions in ``bounds``) of runs of bytes of one kind that is not white space."""
    kinds = KIND[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:-1])
    edge[bounds] = True
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    solid = kinds[starts] != 0 if len(data) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def pairs(hashes: np.ndarray) -> np.ndarray:
    """The hash of each token with the one after it."""
    return mixed(hashes[:-1] * PAIR + hashes[1:])


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)
