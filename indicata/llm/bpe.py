"""Byte-level BPE: encoding by a rank queue under a hierarchical bitmap, and decoding.

A pre-token starts as a linked list of its bytes.  Every adjacent pair that forms a token waits in the bucket of that
token's rank; a bitmap of three levels marks the buckets in use, so the lowest rank is found by three
find-first-set steps, whatever the number of waiting pairs; the pre-tokens that a slice of texts brings anew share the
queue.  Entries made stale by a neighbouring merge are skipped
when they surface.  A pre-token of n bytes costs O(n log n) at worst, so texts without any break stay affordable.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import map_slices, whole_row

#: Pre-tokens remembered by a worker; beyond that it starts anew.  Results don't depend on it.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
SLICE = 2 << 20

# The pre-token pattern that the public byte-level vocabularies use, and the same pattern for texts of
# ASCII and Latin-1 letters only, where its classes can be written out for the built-in engine.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+"""
LATIN_ONLY = re.compile(r"[\t-\r -~À-ÿ]*\Z").match


class RankQueue:
    """Buckets of positions under merge ranks; a bitmap of three levels marks those in use."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank in use with its positions; its bucket closes."""
        top = self.top
        if not top:
            return None
        a = (top & -top).bit_length() - 1
        word = self.mid[a]
        b = (a << 6) + (word & -word).bit_length() - 1
        word = self.low[b]
        rank = (b << 6) + (word & -word).bit_length() - 1
        self.low[b] = word & (word - 1)
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top = top & (top - 1)
        return rank, self.buckets.pop(rank)


class Vocabulary:
    """Merge ranks of a rank file (one ``base64 rank`` a line), with the pattern that cuts a text into pre-tokens."""

    def __init__(self, lines: list[bytes], pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.find_any = regex.compile(pattern).findall
        self.find_latin = re.compile(LATIN_PATTERN).findall if pattern == PATTERN else None
        self.pairs = np.full(1 << 16, -1, np.int32)  # rank of each pair of bytes
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank
        self.queue = RankQueue(max(self.tokens) + 1)
        self.known: dict[str, bytes] = {}

    def find(self, text: str) -> list[str]:
        """Pre-tokens of a text; plain Latin texts take an equal pattern of the faster built-in engine."""
        return self.find_latin(text) if self.find_latin and LATIN_ONLY(text) else self.find_any(text)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each pre-token.  All share one queue: within a piece merges still go by lowest rank, then
        leftmost, since pieces have no pair in common; a bucket's positions are taken from left to right."""
        ranks, queue = self.ranks, self.queue
        buckets = queue.buckets
        text = b"".join(pieces)
        n = len(text)
        stops = np.cumsum([len(x) for x in pieces])
        first = bytearray(n + 1)          # 1 where a piece starts
        np.frombuffer(first, np.uint8)[np.concatenate([[0], stops])] = 1
        end = list(range(1, n + 1))       # of the part that starts here
        before = list(range(-1, n - 1))   # start of the part to the left
        raw = np.frombuffer(text, np.uint8).astype(np.int32)
        initial = np.append(self.pairs[raw[:-1] << 8 | raw[1:]], -1).astype(np.int32)[:n]
        initial[np.frombuffer(first, np.uint8)[1:] == 1] = -1
        waiting = initial.tolist()        # rank under which the pair that starts here waits; -1: none
        where = np.flatnonzero(initial >= 0)
        where = where[np.argsort(initial[where], kind="stable")]
        cuts = np.flatnonzero(np.diff(initial[where])) + 1
        for group in np.split(where, cuts) if len(where) else []:
            queue.open(int(initial[group[0]]), group.tolist())
        while (entry := queue.pop()) is not None:
            rank, positions = entry
            positions.sort()
            rest = iter(positions)
            for i in rest:
                if waiting[i] != rank:
                    continue  # stale
                lower = False
                j = end[i]
                k = end[i] = end[j]
                waiting[j] = -1
                if first[k]:
                    waiting[i] = -1
                else:
                    before[k] = i
                    found = waiting[i] = ranks.get(text[i:end[k]], -1)
                    if found >= 0:
                        lower = found < rank
                        if found in buckets:
                            buckets[found].append(i)
                        else:
                            queue.open(found, [i])
                if not first[i]:
                    h = before[i]
                    found = ranks.get(text[h:k], -1)
                    if found != waiting[h]:
                        waiting[h] = found
                        if found >= 0:
                            lower = lower or found < rank
                            if found in buckets:
                                buckets[found].append(h)
                            else:
                                queue.open(found, [h])
                if lower:  # a pair made just now goes before the rest of this bucket
                    if later := list(rest):
                        queue.open(rank, later)
        out, i = [], 0
        for stop in stops.tolist():
            ids = []
            while i < stop:
                ids.append(ranks[text[i:end[i]]])
                i = end[i]
            out.append(ids)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian int32."""
        split = [self.find(x) if x else [] for x in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*split).difference(known))
        if new:
            merged = self.merge([x.encode() for x in new])
            flat = np.array(list(chain.from_iterable(merged)), "<i4").tobytes()
            stops = np.cumsum([0, *(4 * len(x) for x in merged)]).tolist()
            known.update((x, flat[a:b]) for x, a, b in zip(new, stops, stops[1:]))
        get = known.__getitem__
        out = [b"".join(map(get, x)) for x in split]
        for x in new:
            if len(x) > LONGEST_REMEMBERED:
                del known[x]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def load(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of this Python worker; read once."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path, pattern] = Vocabulary(f.readlines(), pattern)
    return _LOADED[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids array<int>``: every whole text cut by ``pattern``, each match merged on its own by the ranks
    of the file ``path`` (installed on every node; parameter, never copied), without special tokens, and ``decoded
    binary``: the bytes that the ids stand for.

    Null and empty texts give no ids and no bytes.  Columns of ``df`` named ``ids`` or ``decoded`` are replaced.
    Every row is handled alone, so ties and repeated rows need nothing.
    """
    packed = whole_row(df, (text, "text"))
    row = packed.schema["row"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = load(path, pattern)
        flat = vocabulary.encode(batch.column("text").to_pylist())
        offsets = np.cumsum([0, *(len(x) // 4 for x in flat)])
        values = np.frombuffer(b"".join(flat), "<i4")
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
        decoded = pa.array([vocabulary.decode(np.frombuffer(x, "<i4")) for x in flat], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("row"), ids, decoded], ["row", "ids", "decoded"])

    out = map_slices(packed, "text", run, f"row {row}, ids array<int>, decoded binary", SLICE)
    keep = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in ("ids", "decoded")]
    return out.select(*keep, "ids", "decoded")


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded documents."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
