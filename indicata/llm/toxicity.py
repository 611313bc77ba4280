"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Each sentence has a logistic score from its words and word beginnings (0 where it holds none that was learned, so
that length alone never makes a document toxic); a document's score is the noisy-or of its
sentences, 1 - prod(1 - p).  Weights are trained through the noisy-or from document labels alone; the sentence scores
then tell where the offence is.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import map_slices

BREAKS = re.compile(r"[.!?\n]+")
_NOT_WORD = re.compile(r"[\W\d_]+")
BEGINNINGS = (4, 5, 6, 7)
REMEMBERED = 500_000


def held_out(key: Column, parts: int = 5, part: int = 0) -> Column:
    """Whether crc32 of the key as text falls in the part kept from learning; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == part, F.lit(False))


def features(token: str) -> list[str]:
    """A token's word (letters only) and its beginnings, marked by a star."""
    word = _NOT_WORD.sub("", token)
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)] if word else []


class _Weights(dict):
    """Weight of a token: the sum over its features; filled as tokens come."""

    def __init__(self, by_feature: dict[str, float]):
        super().__init__()
        self.by_feature = by_feature

    def __missing__(self, token: str) -> float:
        weight = sum(self.by_feature.get(x, 0.0) for x in features(token))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(token) <= 64:
            self[token] = weight
        return weight


@dataclass
class Model:
    """Weights by feature and the bias of a sentence."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -12.0

    def __post_init__(self):
        self._tokens = _Weights(self.weights)

    def __getstate__(self):
        return self.weights, self.bias

    def __setstate__(self, state):
        self.weights, self.bias = state
        self._tokens = _Weights(self.weights)

    def sentences(self, text: str) -> list[float]:
        """Log-odds of each sentence that holds a weighted feature; the others score 0."""
        get = self._tokens.__getitem__
        sums = (sum(map(get, x.split())) for x in BREAKS.split(text.lower()))
        return [self.bias + x for x in sums if x]

    def score(self, text: str | None) -> float:
        """1 - prod(1 - p) over the sentences; 0 without any."""
        odds = np.array(self.sentences(text)) if text else np.empty(0)
        return float(-np.expm1(-np.logaddexp(0.0, odds).sum()))

    def spans(self, text: str, at_least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, p) of the sentences with a score of at least ``at_least``."""
        get, out, start = self._tokens.__getitem__, [], 0
        for stop in [m.span() for m in BREAKS.finditer(text)] + [(len(text), len(text))]:
            weight = sum(map(get, text[start:stop[0]].lower().split()))
            p = 1 / (1 + np.exp(-self.bias - weight))
            if weight and p >= at_least:
                out.append((start, stop[0], float(p)))
            start = stop[1]
        return out


def fit(texts: list[str], toxic: np.ndarray, steps: int = 400, rate: float = 0.3, shrink: float = 1e-4,
        least_rows: int = 4, lift: float = 3.0) -> Model:
    """Train on documents and labels.  A feature takes part if at least ``least_rows`` toxic documents hold it and it
    is ``lift`` times as frequent among them as among the others.  One kind of label only: a model that scores 0."""
    toxic = np.asarray(toxic, bool)
    n_bad, n_good = int(toxic.sum()), int((~toxic).sum())
    if not n_bad or not n_good:
        return Model()

    def held(text: str) -> set[str]:
        return set(chain.from_iterable(map(features, set(" ".join(BREAKS.split(text.lower())).split()))))

    bad = Counter(chain.from_iterable(held(t) for t, y in zip(texts, toxic) if y))
    bad = {x: n for x, n in bad.items() if n >= least_rows}
    good = Counter(chain.from_iterable(held(t) & bad.keys() for t, y in zip(texts, toxic) if not y))
    chosen = {x: k for k, x in enumerate(sorted(
        x for x, n in bad.items() if n / n_bad >= lift * (good[x] + 0.5) / n_good))}
    rows, cols, owner = [], [], []
    known: dict[str, tuple[int, ...]] = {}  # chosen features of a token
    for d, text in enumerate(texts):
        for sentence in BREAKS.split(text.lower()):
            found = set()
            for token in sentence.split():
                if token not in known:
                    known[token] = tuple(chosen[x] for x in features(token) if x in chosen)
                found.update(known[token])
            if found:
                cols.extend(found)
                rows.extend([len(owner)] * len(found))
                owner.append(d)
    del known
    rows, cols, owner = np.array(rows, int), np.array(cols, int), np.array(owner, int)
    n, m = len(texts), len(chosen)
    w, b = np.zeros(m), -4.0
    seen, seen_b = np.full(m, 1e-8), 1e-8
    for _ in range(steps):
        z = b + np.bincount(rows, w[cols], len(owner))
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(owner, np.logaddexp(0.0, z), n))  # prod(1 - p)
        pull = np.where(toxic, -clean / np.maximum(1 - clean, 1e-9), 1.0) / n
        by_sentence = pull[owner] * p
        g, g_b = np.bincount(cols, by_sentence[rows], m), by_sentence.sum()
        seen += g * g
        seen_b += g_b * g_b
        step = rate / np.sqrt(seen)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0.0)
        b = max(b - rate * g_b / np.sqrt(seen_b), -16.0)
    names = list(chosen)
    return Model({names[k]: float(w[k]) for k in np.flatnonzero(np.abs(w) > 1e-6)}, float(b))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          most_rows: int = 8_000, most_chars: int = 24_000_000) -> Model:
    """Train on a bounded sample of labelled documents (null is no label; a key with several labels has the highest).

    The sample are the ``most_rows`` labelled keys of lowest hash; of these, in that order, those whose whole texts
    still fit into ``most_chars``: a text that doesn't is left out, those after it aren't.  Only keys and lengths, then
    the texts of the sample reach the driver.  Texts that are null count as empty; of rows that share a key the least
    text counts.  Keys are integers: those of another type that don't read as one fail the job.
    """
    k, y = F.col(f"`{key}`").cast("long"), F.col(f"`{label}`")
    known = labels.where(k.isNotNull() & y.isNotNull()).groupBy(k.alias("key")).agg(F.max(y).alias("label"))
    order = [F.xxhash64("key"), F.col("key")]
    sample = known.orderBy(*order).limit(most_rows)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(k.alias("key"), body.alias("text")).join(F.broadcast(sample), "key")
    rows = rows.groupBy("key", "label").agg(F.min("text").alias("text"))
    chosen, left = [], most_chars
    for row in rows.select("key", F.length("text").alias("n")).orderBy(*order).collect():   # ``most_rows`` at most
        if row.n <= left:
            chosen.append((row.key,))
            left -= row.n
    chosen = docs.sparkSession.createDataFrame(chosen, "key bigint")
    seen = rows.join(F.broadcast(chosen), "key").orderBy(*order).select("text", "label").toPandas()
    return fit(seen["text"].tolist(), seen["label"].to_numpy() > 0)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted, offending`` of every row by its whole text: the noisy-or, 1 from 0.5 on, and the
    sentences that alone reach 0.5 (start and end in code points, and score).

    Null, empty and wordless texts score 0.  Rows are handled alone; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the learning sample's vocabulary
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, found = [], []
        for x in batch.column("text").to_pylist():
            scores.append(shared.value.score(x))
            found.append([dict(zip(("start", "end", "score"), s)) for s in shared.value.spans(x)]
                         if scores[-1] >= 0.5 else [])
        predicted = [int(x >= 0.5) for x in scores]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array(predicted, pa.int32()),
                                           pa.array(found, span)], ["doc_id", "score", "predicted", "offending"])

    return map_slices(rows, "text", run, f"doc_id {kind}, score double, predicted int, "
                      "offending array<struct<start: int, end: int, score: double>>")
