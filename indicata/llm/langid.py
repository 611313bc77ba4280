"""Language identification by a mixture of languages within each document.

Byte trigrams of lower-cased text are counted per language over all learning rows.  A document is a sequence of short
passages; each passage has one likelihood per language from its trigrams.  Expectation-maximisation estimates the
document's language proportions; languages are dropped one by one, rarest first, and the set with the highest
likelihood less a penalty per language is kept.  The prediction is the largest proportion in that set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import map_slices

BINS = 1 << 16
#: Trigrams a passage holds at most; passages of a document are cut evenly.
PASSAGE = 48
STEPS = 12
_HAS_LETTER = regex.compile(r"\p{L}").search
#: Bytes that aren't letters (of ASCII) count as one blank; upper case counts as lower.
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[:128] = 32
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the key as text falls in the part kept from learning; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == part, F.lit(False))


def trigrams(raw: np.ndarray) -> np.ndarray:
    """The bin of the trigram that starts at each byte (the last two wrap on to blanks)."""
    x = np.concatenate([_CLASS[raw], np.full(2, 32, np.uint32)])
    h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.int32)


def latin_lower(text: str) -> str:
    """Lower case for what isn't ASCII; ASCII is folded with the bytes."""
    return text if text.isascii() else text.lower()


@dataclass
class Model:
    """Languages and, for each trigram bin, the log-probability in each of them (float32, BINS by languages)."""

    languages: list[str]
    logs: np.ndarray

    def passages(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods by passage and language, and the number of passages of each (non-empty) document."""
        sizes = np.diff(off)
        counts = -(-sizes // PASSAGE)
        owner = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = off[owner] + nth * sizes[owner] // counts[owner]
        return np.add.reduceat(self.logs[trigrams(raw)], starts, axis=0), counts

    def mixtures(self, like: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions (documents by languages, 0 outside the chosen set)."""
        first = np.cumsum(counts) - counts
        n, langs = len(counts), like.shape[1]
        share = like - like.max(axis=1, keepdims=True)
        np.exp(share, out=share)
        active = np.ones((n, langs), bool)
        best = np.full(n, -np.inf)
        chosen = np.zeros((n, langs))
        pi = np.full((n, langs), 1.0 / langs)
        penalty = 0.5 * np.log(np.maximum(counts, 2)) + 1.0
        todo = np.arange(n)
        while len(todo):
            rows = np.repeat(first[todo] - np.cumsum(counts[todo]) + counts[todo], counts[todo]) + np.arange(
                counts[todo].sum())
            own, begins = np.repeat(np.arange(len(todo)), counts[todo]), np.cumsum(counts[todo]) - counts[todo]
            p, s = pi[todo], share[rows]
            for _ in range(STEPS):
                joint = s * p[own]
                total = np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
                p = np.add.reduceat(joint / total, begins, axis=0) / counts[todo][:, None]
            total = np.maximum((s * p[own]).sum(axis=1), 1e-300)
            size = active[todo].sum(axis=1)
            score = np.add.reduceat(np.log(total), begins) - penalty[todo] * (size - 1)
            better = score > best[todo]
            best[todo[better]], chosen[todo[better]] = score[better], p[better]
            # drop the rarest language of each set; a set of one is the last
            rarest = np.where(active[todo], p, np.inf).argmin(axis=1)
            active[todo, rarest] = False
            p[np.arange(len(todo)), rarest] = 0.0
            keep = (size > 1) & (p.sum(axis=1) > 0)
            # what is left of a set after its only real language went can't win
            p = p[keep] / p[keep].sum(axis=1, keepdims=True)
            todo = todo[keep]
            pi[todo] = p
        return chosen

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its proportion; ``und`` and 0 without text, letter or model."""
        usable = [i for i, x in enumerate(texts) if self.languages and x and _HAS_LETTER(x)]
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if usable:
            raws = [latin_lower(texts[i]).encode() for i in usable]
            off = np.cumsum([0, *map(len, raws)])
            pi = self.mixtures(*self.passages(np.frombuffer(b"".join(raws), np.uint8), off))
            top = pi.argmax(axis=1)
            scores[usable] = np.minimum(pi[np.arange(len(top)), top], 1.0)
            for i, k in zip(usable, top.tolist()):
                names[i] = self.languages[k]
        return names, scores


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Model:
    """Trigram counts of every whole text whose ``lang`` isn't null.  What reaches the driver is one row per language
    and bin in use, at most 65,536 times the number of languages, whatever the number of documents.  No rows: a model
    without languages."""
    known = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(
        F.col("lang").isNotNull() & (F.coalesce(F.length("text"), F.lit(0)) > 0))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for name in sorted(set(names)):
                raw = " ".join(latin_lower(t) for t, x in zip(texts, names) if x == name).encode()
                got = np.bincount(trigrams(np.frombuffer(raw, np.uint8)), minlength=BINS)
                sums[name] = sums[name] + got if name in sums else got
        for name, got in sums.items():
            bins = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(bins)), pa.array(bins, pa.int32()),
                                              pa.array(got[bins], pa.int64())], ["lang", "bin", "n"])

    counts = known.mapInArrow(count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(
        F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    logs = np.full((BINS, len(languages)), smoothing)
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        logs[own["bin"].to_numpy(), k] += own["n"].to_numpy()
    return Model(languages, np.log(logs / logs.sum(axis=0)).astype(np.float32))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row by its whole text.

    ``und`` with score 0: null, empty, or without a letter (or a model that saw no language).  Rows are handled alone:
    repeated rows get equal results, an empty table none.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BINS by languages: its size doesn't follow the documents
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = shared.value.predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                                          ["doc_id", "lang_pred", "score"])

    return map_slices(rows, "text", run, f"doc_id {kind}, lang_pred string, score double")
