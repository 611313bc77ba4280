"""Removal of repeated byte strings across all documents, by suffix arrays with common prefixes.

Every string of ``length`` bytes has an anchor: the leftmost least hash among its grams of GRAM bytes.  Equal strings
have equal anchors at equal places, so strings need to be compared only with those of the same anchor.  Consecutive
strings of a document with one anchor are a run; its context are the bytes they cover.

1. Runs are emitted as hashes only.  Anchors that come once are done with.
2. Contexts that come twice or more repeat whole: no text is needed.
3. Where one anchor has several contexts, one copy of each is cut from the texts, and blocks of such groups are sorted
   by the two-stage suffix sort; neighbours with a common prefix of ``length`` bytes repeat.
4. Groups with more contexts than a block holds are cut finer: strings that lie alike to the anchor are taken in
   pieces of 32 (then 4, then 1), grouped by the bytes that all strings of a piece share, and 2 and 3 apply again.

Nothing is dropped or capped, and no group meets in one task, however many documents share a passage.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm import shingles, suffixes
from indicata.llm.common import map_groups, map_slices, utf8
from indicata.sinks.files import materialize

LENGTH, GRAM = 400, 32
SLICE = 1 << 20
#: Strings whose anchors are found at once; positions within fit the low bits of the order.
AT_ONCE, LOW = 1 << 23, 24
#: Contexts of one anchor that are sorted together, and bytes of contexts in one suffix array.
TOGETHER, BLOCK = 1024, 512 << 10
#: Strings in a piece of a context, level by level; a piece of one string is compared whole by its hash.
PIECES = (32, 4, 1)

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * shingles.powers(_BASE, n), out=sums[1:])
    return shingles.mixed((sums[gram:] - sums[:-gram]) * shingles.powers(_INVERSE, n)[:n - gram + 1])


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(raw: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of strings with one anchor: text, first start (within all), number of strings, anchor place, anchor hash."""
    n = len(raw)
    if n < length:
        none = np.empty(0, np.int64)
        return none, none, none, none, np.empty(0, np.uint64)
    anchors = np.empty(n - length + 1, np.int64)
    hashes = gram_hashes(raw, gram)
    low = np.uint64((1 << LOW) - 1)
    for first in range(0, len(anchors), AT_ONCE):
        own = hashes[first:first + AT_ONCE + length - gram]
        order = (own & ~low) | np.arange(len(own), dtype=np.uint64)
        least = least_in_windows(order, length - gram + 1)
        anchors[first:first + AT_ONCE] = first + (least & low).astype(np.int64)
    counts = np.maximum(np.diff(off) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.repeat(off[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    anchor = anchors[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    number = np.diff(np.append(first, len(start)))
    return text[first], start[first], number, anchor[first] - start[first], hashes[anchor[first]]


def _run_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    raw, off = utf8(batch, "text")
    text, start, number, place, anchor = runs(raw, off)
    whole = raw.tobytes()
    digest = hashlib.blake2b
    contexts = np.frombuffer(b"".join([digest(whole[a:a + n + LENGTH - 1], digest_size=8).digest()
                                       for a, n in zip(start.tolist(), number.tolist())]), np.int64)
    take = pa.array(text)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(start - off[text]),
         pa.array(number.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(anchor.view(np.int64)),
         pa.array(contexts ^ shingles.mixed(place.astype(np.uint64)).view(np.int64))],
        ["doc_id", "th", "start", "n", "place", "anchor", "context"])


def _repeats(group: pa.Table) -> pa.Table | None:
    """Spans of the single contexts' strings that another context of the block holds."""
    raw, off = utf8(group.combine_chunks().to_batches()[0], "bytes")
    number = group.column("n").to_numpy()
    mask = np.zeros(len(raw), bool)
    at = np.repeat(off[:-1] - np.cumsum(number) + number, number) + np.arange(number.sum())
    mask[at] = True
    hit = suffixes.repeated(raw, mask, LENGTH)[at]
    owner = np.repeat(np.arange(len(number)), number)
    hit &= (group.column("m").to_numpy() == 1)[owner]
    if not hit.any():
        return None
    edge = np.ones(len(at), bool)
    edge[1:] = ~hit[:-1] | (owner[1:] != owner[:-1])
    first = np.flatnonzero(hit & edge)
    ends = np.ones(len(at), bool)
    ends[:-1] = ~hit[1:] | (owner[1:] != owner[:-1])
    last = np.flatnonzero(hit & ends)
    rows = owner[first]
    base = group.column("start").to_numpy()[rows] - off[rows]
    take = pa.array(rows)
    return pa.table({"doc_id": group.column("doc_id").take(take), "th": group.column("th").take(take),
                     "start": pa.array(base + at[first]), "end": pa.array(base + at[last] + LENGTH)})


def _pieces(span: int):
    """Contexts in pieces of up to ``span`` strings, cut at fixed places before the anchor.  The key of a piece is a
    hash of what all strings of that place range share, wherever the context begins or ends."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = utf8(batch, "bytes")
        whole = raw.tobytes()
        rows: list[tuple] = []
        for i, (n, place, key) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n", "place", "key")))):
            anchor, t = int(off[i]) + place, 0
            while t < n:
                part = (place - t) // span
                count = min(n - t, place - t - part * span + 1)
                at = int(off[i]) + t
                core = whole[anchor - part * span:anchor - part * span - span + 1 + LENGTH]
                digest = hashlib.blake2b(core, digest_size=8, salt=(key & (1 << 64) - 1).to_bytes(8, "little"),
                                         person=part.to_bytes(4, "little")).digest()
                own = whole[at:at + count + LENGTH - 1]
                context = hashlib.blake2b(own, digest_size=8, person=(place - t).to_bytes(4, "little")).digest()
                rows.append((i, t, count, place - t, int.from_bytes(digest, "little", signed=True),
                             int.from_bytes(context, "little", signed=True), own))
                t += count
        i, t, count, place, key, context, own = zip(*rows)
        take = pa.array(i, pa.int64())
        start = batch.column("start").to_numpy()[list(i)] + np.array(t)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(start), pa.array(count, pa.int32()),
             pa.array(place, pa.int32()), pa.array(key, pa.int64()), pa.array(context, pa.int64()),
             batch.column("m").take(take), pa.array(own, pa.binary())],
            ["doc_id", "th", "start", "n", "place", "key", "context", "m", "bytes"])

    return run


def _span() -> list:
    return [F.col("start"), (F.col("start") + F.col("n") + (LENGTH - 1)).alias("end")]


def within_groups(opened: DataFrame, ids: str) -> DataFrame:
    """Spans of the strings that another context of their group holds, of ``opened(doc_id, th, start, n, place, key, m,
    d, bytes)``: one row for each of the ``d`` contexts of a key, with ``m`` 1 if it occurs once."""
    spans = f"{ids}, start bigint, end bigint"
    found = []
    for span in (*PIECES, None):
        found.append(map_groups(opened.where(F.col("d") <= TOGETHER).drop("d", "place"), "key", _repeats, spans,
                                gather=BLOCK))
        large = opened.where(F.col("d") > TOGETHER)
        if span is None or large.isEmpty():
            break
        pieces = materialize(map_slices(
            large.drop("d"), "bytes", _pieces(span), f"{ids}, start bigint, n int, place int, key bigint, "
            "context bigint, m int, bytes binary", SLICE), "string-pieces")
        contexts = pieces.groupBy("key", "context").agg(
            F.sum("m").alias("all"), F.min(F.struct("doc_id", "th", "start")).alias("one"))
        contexts = contexts.join(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("d")), "key")
        known = materialize(pieces.join(contexts, ["key", "context"]), "string-piece-contexts")
        found.append(known.where("all > 1 AND m = 1").select("doc_id", "th", *_span()))
        first = F.struct("doc_id", "th", "start").eqNullSafe(F.col("one"))
        opened = known.where(F.col("d") > 1).where(first).select(
            "doc_id", "th", "start", "n", "place", "key", F.least("all", F.lit(2)).cast("int").alias("m"), "d", "bytes")
    return reduce(DataFrame.unionByName, found)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``doc_id, th, start, end`` (bytes): spans of repeated strings, which may overlap, of ``rows(doc_id, th,
    text)``."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = f"doc_id {kind}, th bigint"
    found = materialize(map_slices(
        rows, "text", _run_rows, f"{ids}, start bigint, n int, place int, anchor bigint, context bigint", SLICE),
        "string-runs")
    # what is joined back to its own rows is written first: then both sides are plain shuffles, and one anchor with
    # very many rows is split
    often = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("all")).where("all > 1").select("anchor")
    found = materialize(found.join(materialize(often, "string-often"), "anchor"), "string-anchors")
    contexts = materialize(found.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("m"), F.min(F.struct("doc_id", "th", "start", "n", "place")).alias("one")),
        "string-anchor-contexts")
    mixed = materialize(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "string-mixed")
    contexts = materialize(contexts.join(mixed, "anchor", "left"), "string-contexts")
    whole = found.join(contexts.where("m > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "doc_id", "th", *_span())

    open_ = contexts.where("d > 1").select("one.*", F.col("anchor").alias("key"), F.least("m", F.lit(2)).cast("int").alias("m"), "d")
    wanted = open_.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n", "place", "key", "m", "d")).alias("cuts"))
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["th"] == wanted["th"])).select(
        rows["doc_id"], rows["th"], "text", "cuts")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = utf8(batch, "text")
        whole_raw = raw.tobytes()
        cuts = batch.column("cuts")
        parts = cuts.flatten()
        starts, n = parts.field("start").to_numpy(), parts.field("n").to_numpy()
        owner = np.repeat(np.arange(batch.num_rows), cuts.value_lengths().to_numpy())
        cut_bytes = [whole_raw[a:a + b + LENGTH - 1] for a, b in zip((off[owner] + starts).tolist(), n.tolist())]
        take = pa.array(owner)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("th").take(take), parts.field("start"), parts.field("n"),
             parts.field("place"), parts.field("key"), parts.field("m"), parts.field("d"),
             pa.array(cut_bytes, pa.binary())],
            ["doc_id", "th", "start", "n", "place", "key", "m", "d", "bytes"])

    opened = materialize(map_slices(texts, "text", cut, f"{ids}, start bigint, n int, place int, key bigint, m int, "
                                    "d bigint, bytes binary", SLICE), "string-bytes")
    return whole.unionByName(within_groups(opened, ids))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans, kept`` of every row: the maximal runs of bytes (start, end) that a string of 400 bytes covers
    which starts somewhere else, too, in this or another row; and the remaining bytes.

    Texts are taken as UTF-8 bytes, null as empty; strings never reach across rows; what overlaps counts.  Equal rows
    count as two places.  Texts under 400 bytes have no spans; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("th"))
    spans = repeated_spans(rows).groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("start", "end")).alias("found"))  # at most a few for each hundred bytes of one text
    both = rows.join(spans, rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["th"] == spans["th"]), "left").select(
        rows["doc_id"], "text", "found")
    kind = rows.schema["doc_id"].dataType.simpleString()
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, spans = [], []
        for x, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            raw = x.encode()
            merged: list[list[int]] = []
            for a, b in sorted((y["start"], y["end"]) for y in found or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            edges = [0, *(y for z in merged for y in z), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else raw)
            spans.append([{"start": a, "end": b} for a, b in merged])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pair), pa.array(kept, pa.binary())],
                                          ["doc_id", "spans", "kept"])

    return map_slices(both, "text", cut, f"doc_id {kind}, spans array<struct<start: bigint, end: bigint>>, kept binary")


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of the documents."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return removed.select("doc_id", (F.length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
