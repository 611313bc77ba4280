"""Hashes of words and of word shingles for whole batches of texts, in numpy."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_RNG = np.random.default_rng(20240607)
#: A random 64-bit number for each byte; A-Z share those of a-z.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled:filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(raw: np.ndarray, off: np.ndarray,
          apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and the words before each text (length texts + 1); A-Z count as a-z.
    Words end at the bytes that ``apart`` marks (ASCII white space) and with their text."""
    n = len(raw)
    if n == 0:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, np.zeros(len(off), np.int64)
    inside = ~apart[raw]
    edge = np.zeros(n + 1, bool)
    edge[off] = True  # a text's edge parts words even without white space
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1] | edge[1:n]]))
    ends = np.flatnonzero(inside & np.concatenate([~inside[1:] | edge[1:n], [True]])) + 1
    power = powers(_BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power, out=sums[1:])
    back = powers(_BASE_INVERSE, n)
    hashes = mixed((sums[ends] - sums[starts]) * back[starts])
    return hashes, starts, ends, np.searchsorted(starts, off)


def runs_of_words(hashes: np.ndarray, before: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text (the whole text as one if it has fewer, none without words)
    and the runs before each text."""
    counts = np.diff(before)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(before[:-1] - np.cumsum(n) + n, n) + np.arange(n.sum())
    width = np.minimum(np.repeat(counts, n), size)
    total = width.astype(np.uint64)  # a shorter text can't equal a run
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for j in range(size):
        total = mixed(total * np.uint64(_BASE) + np.where(width > j, padded[first + j], np.uint64(0)))
    return total, np.concatenate([[0], np.cumsum(n)])


def sets(hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in ascending order, and their number before each text."""
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(before)))
