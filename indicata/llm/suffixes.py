"""Suffix arrays by two-stage sorting, with the common prefixes of neighbours, in numpy.

Order up to a depth is enough here: suffixes that agree on ``depth`` bytes may stand in any order.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later (the end is smaller than any byte)."""
    n = len(text)
    starts = np.concatenate([[0], np.flatnonzero(text[1:] != text[:-1]) + 1])
    chars = text[starts].astype(np.int16)
    rising = np.append(chars[1:] > chars[:-1], False)
    return np.repeat(rising, np.diff(np.append(starts, n)))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes in order of their first ``depth`` bytes at least."""
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    rising = smaller_than_next(text)
    # stage one: sort the suffixes that are smaller than their successors
    raw = text.tobytes()
    direct = np.flatnonzero(rising).tolist()
    direct.sort(key=lambda i: raw[i:i + depth])
    direct = np.array(direct, np.int64)
    # stage two: induce the rest by scanning the buckets of first bytes upwards; in a bucket the induced come first
    sizes = np.bincount(text, minlength=256)
    begin = np.cumsum(sizes) - sizes
    sorted_sizes = np.bincount(text[direct], minlength=256)
    sorted_before = np.cumsum(sorted_sizes) - sorted_sizes
    out = np.empty(n, np.int64)
    head = begin.copy()
    out[head[text[-1]]] = n - 1
    head[text[-1]] += 1

    def induce(block: np.ndarray) -> None:
        before = block[block > 0] - 1
        before = before[~rising[before]]
        if not len(before):
            return
        bucket = text[before]
        order = np.argsort(bucket, kind="stable")
        before, bucket = before[order], bucket[order].astype(np.int64)
        counts = np.bincount(bucket, minlength=256)
        first = np.cumsum(counts) - counts
        out[head[bucket] + np.arange(len(before)) - first[bucket]] = before
        head[:] += counts

    for c in np.flatnonzero(sizes).tolist():
        done = begin[c]
        while done < head[c]:  # a run of one byte induces within its own bucket
            upto = head[c]
            induce(out[done:upto])
            done = upto
        own = direct[sorted_before[c]:sorted_before[c] + sorted_sizes[c]]
        out[begin[c] + sizes[c] - len(own):begin[c] + sizes[c]] = own
        induce(own)
    return out


def share_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` (which all have ``length`` bytes, a multiple of 8) agree on them."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(text), 8), (1, 1)).copy().view(np.uint64).ravel()
    same = np.arange(len(a))
    for at in range(0, length, 8):
        same = same[eight[a[same] + at] == eight[b[same] + at]]
        if not len(same):
            break
    out = np.zeros(len(a), bool)
    out[same] = True
    return out


def repeated(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings of ``length`` bytes at ``starts`` (a mask over the text) start twice or more: by the
    common prefixes of neighbours in the suffix array."""
    order = suffix_array(text, length)
    order = order[starts[order]]
    out = np.zeros(len(text), bool)
    if len(order) > 1:
        same = share_prefix(text, order[:-1], order[1:], length)
        out[order[:-1][same]] = True
        out[order[1:][same]] = True
    return out
