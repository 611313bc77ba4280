"""Ranked lexical search by bag deduplication.

Documents are restricted to the vocabulary of the items: what is left of one is its bag (terms and their counts).
Documents with the same bag and the same length norm m score alike for every item, so they form a class: classes are
dealt out by hash and told apart by the whole bag.  Each class is scored once, by scattering the weighted postings of
its terms over the items; the best classes of an item are then expanded to their members by ascending id.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm import shingles
from indicata.llm.common import map_slices, utf8
from indicata.sinks.files import materialize

#: A term is a maximal run of ASCII letters and digits and of anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 20
#: Items are taken in blocks of about so many characters, which bounds the vocabulary that a task holds.
IN_BLOCK = 8 << 20
#: Cells (classes times items) that a task scores at once.
CELLS = 1 << 21
#: Documents are weighed by m = FLAT + BY_LENGTH * n / average n, in integers.
FLAT, BY_LENGTH = 75, 25

_BYTES = np.arange(256)
_APART = (_BYTES < 128) & ~(((_BYTES >= 48) & (_BYTES < 58)) | ((_BYTES >= 65) & (_BYTES < 91)) |
                            ((_BYTES >= 97) & (_BYTES < 123)))
_LOWER = _BYTES.astype(np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_LEAST = -(1 << 63)


def terms(text: str | None) -> list[str]:
    """The terms of a text, A-Z as a-z; none of null."""
    return re.findall(TERM, (text or "").translate({c: c + 32 for c in range(65, 91)}))


class Vocabulary:
    """The terms of a block of items in byte order: their hashes, bytes, and the items that hold them."""

    def __init__(self, texts: list[str]):
        bags: list[dict[str, int]] = []
        for text in texts:
            bag: dict[str, int] = {}
            for x in terms(text):
                bag[x] = bag.get(x, 0) + 1
            bags.append(bag)
        self.terms = sorted({x.encode() for bag in bags for x in bag})
        place = {x: i for i, x in enumerate(self.terms)}
        self.size, self.items = len(self.terms), len(texts)
        self.raw = np.frombuffer(b"".join(self.terms), np.uint8)
        self.off = np.concatenate([[0], np.cumsum([len(x) for x in self.terms], dtype=np.int64)]).astype(np.int64)
        hashes = shingles.words(self.raw, self.off, np.zeros(256, bool))[0]
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ArithmeticError("two terms of the items share a 64-bit hash")
        held = sorted((place[x.encode()], i, n) for i, bag in enumerate(bags) for x, n in bag.items())
        held = np.array(held, np.int64).reshape(-1, 3)
        self.start = np.searchsorted(held[:, 0], np.arange(self.size + 1))
        self.item, self.times = held[:, 1], held[:, 2]

    def find(self, raw: np.ndarray, hashes: np.ndarray, starts: np.ndarray,
             ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words (by place) that are terms, and the terms; equal hashes are verified byte by byte."""
        none = np.empty(0, np.int64)
        if not self.size or not len(hashes):
            return none, none
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
        word = np.flatnonzero(self.hashes[at] == hashes)
        term = self.order[at[word]]
        length = ends[word] - starts[word]
        same = length == self.off[term + 1] - self.off[term]
        word, term, length = word[same], term[same], length[same]
        if not len(word):
            return none, none
        before = np.cumsum(length) - length
        within = np.arange(length.sum()) - np.repeat(before, length)
        unlike = _LOWER[raw[np.repeat(starts[word], length) + within]] != self.raw[
            np.repeat(self.off[term], length) + within]
        same = np.add.reduceat(unlike, before, dtype=np.int64) == 0
        return word[same], term[same]


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n, bag`` of documents with a term: how many terms, and pairs (term of the vocabulary, count) in order
    of terms, packed."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = utf8(batch, "text")
        hashes, starts, ends, before = shingles.words(raw, off, _APART)
        word, term = vocabulary.find(raw, hashes, starts, ends)
        owner = np.searchsorted(before, word, "right") - 1
        cell, count = np.unique(owner * max(vocabulary.size, 1) + term, return_counts=True)
        owner, term = np.divmod(cell, max(vocabulary.size, 1))
        pairs = np.column_stack([term, count]).astype(np.int32)
        ends8 = (8 * np.searchsorted(owner, np.arange(batch.num_rows + 1))).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
            None, pa.py_buffer(ends8.tobytes()), pa.py_buffer(pairs.tobytes())])
        n = np.diff(before)
        rows = pa.array(np.flatnonzero(n))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), pa.array(n).take(rows),
                                           packed.take(rows)], ["doc_id", "n", "bag"])

    return map_slices(docs, "text", run, "doc_id bigint, n bigint, bag binary")


def document_counts(classes: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term, from bags and their copies; a task gives one row for each term it met."""
    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            raw, off = utf8(batch, "bag")
            term = raw.view(np.int32)[::2]
            copies = np.repeat(batch.column("copies").to_numpy(), np.diff(off) // 8)
            np.add.at(held, term, copies)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["term", "df"])

    counted = classes.select("bag", "copies").mapInArrow(run, "term int, df bigint").groupBy("term").agg(
        F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for term, df in counted.collect():  # at most one row for each term of a block of items
        out[term] = df
    return out


def _best(classes: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, k: int) -> DataFrame:
    """``item, score, h1, h2, first``: each task's k best classes for each item, equal scores by least member."""
    v = vocabulary

    def scored(bag: np.ndarray, owner: np.ndarray, m: np.ndarray) -> np.ndarray:
        term, tf = bag[::2], bag[1::2].astype(np.int64)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[owner]))
        held = v.start[term + 1] - v.start[term]
        reach = np.repeat(v.start[term] - np.cumsum(held) + held, held) + np.arange(held.sum())
        cells = np.repeat(owner * v.items, held) + v.item[reach]
        value = np.repeat(impact, held) * v.times[reach]
        size = len(m) * v.items
        if value.sum(dtype=np.float64) < 2 ** 53:  # then sums in doubles are exact, too
            return np.bincount(cells, value, size).astype(np.int64).reshape(-1, v.items)
        out = np.zeros(size, np.int64)
        np.add.at(out, cells, value)
        return out.reshape(-1, v.items)

    def run(batches):
        pool = [np.empty(0, np.int64)] * 5  # item, score, first, h1, h2
        least = np.ones(v.items, np.int64)

        def cut(pool):
            order = np.lexsort((pool[4], pool[3], pool[2], -pool[1], pool[0]))
            pool = [x[order] for x in pool]
            first = np.searchsorted(pool[0], pool[0])
            nth = np.arange(len(pool[0])) - first
            full = nth == k - 1
            least[pool[0][full]] = pool[1][full]
            return [x[nth < k] for x in pool]

        step = max(1, CELLS // max(v.items, 1))
        for batch in batches:
            raw, off = utf8(batch, "bag")
            bag = raw.view(np.int32)
            columns = [batch.column(c).to_numpy() for c in ("m", "first", "h1", "h2")]
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                m, first, h1, h2 = (x[a:b] for x in columns)
                sizes = np.diff(off[a:b + 1]) // 8
                score = scored(bag[off[a] // 4:off[b] // 4], np.repeat(np.arange(b - a), sizes), m)
                row, item = np.nonzero(score >= least)
                new = [item, score[row, item], first[row], h1[row], h2[row]]
                pool = [np.concatenate(x) for x in zip(pool, new)]
                if len(pool[0]) > 4 * k * v.items:
                    pool = cut(pool)
        pool = cut(pool)
        if len(pool[0]):
            yield pa.RecordBatch.from_arrays([pa.array(pool[0].astype(np.int32)), *(pa.array(x) for x in pool[1:])],
                                             ["item", "score", "first", "h1", "h2"])

    return classes.select("bag", "m", "first", "h1", "h2").mapInArrow(
        run, "item int, score bigint, first bigint, h1 bigint, h2 bigint")


def _search_block(docs: DataFrame, items: list[tuple[int | None, str]], k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = Vocabulary([text for _, text in items])
    held = materialize(bags(docs, vocabulary), "bags")
    n_docs, total = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = held.where(F.length("bag") > 0).withColumn(
        "m", FLAT + F.expr(f"({BY_LENGTH} * n * {n_docs}L) div {max(total, 1)}L"))
    # equal hashes only bring bags together: groups are of equal whole bags; the least member names and orders a class
    classes = materialize(held.groupBy("bag", "m").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.coalesce("doc_id", F.lit(_LEAST))).alias("first")).select(
        "*", F.xxhash64("bag", "m").alias("h1"), F.xxhash64(F.lit("again"), "m", "bag").alias("h2")), "bag-classes")
    df = document_counts(classes, vocabulary.size)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    # a document among the k best of an item is in one of the k best classes by (score, least member)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "h1", "h2")
    best = _best(classes, vocabulary, weights, k).withColumn("nth", F.row_number().over(order)).where(
        F.col("nth") <= k).drop("nth", "first")
    best = materialize(best.join(classes.select("h1", "h2", "bag", "m"), ["h1", "h2"]), "bag-best")
    named = spark.createDataFrame([(i, x[0]) for i, x in enumerate(items)], "item int, item_id bigint")
    found = held.withColumn("h1", F.xxhash64("bag", "m")).join(best, ["h1", "bag", "m"]).select(
        "item", "score", "doc_id")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(
        named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", k: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` best documents (all, if fewer) with a score above 0.

    Equal scores are ranked by ascending id, null ids first; ids are integers.  Documents with null or empty text, or
    without a term, count nowhere; rows that repeat an id are documents of their own.  Equal item rows are one item;
    rows that share an id but not the text are items of their own.  Items without a term and empty tables give no
    rows.  Items are taken in blocks of bounded text, which alone go through the driver; each block meets all
    documents.  Scores are 64-bit integers.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    asked = items.select(F.col(f"`{item_key}`").cast("bigint").alias("id"), F.col(f"`{item_text}`").alias("text"))
    asked = asked.where(F.col("text").rlike(TERM)).distinct()
    blocks = max(1, math.ceil((asked.agg(F.sum(F.length("text"))).first()[0] or 0) / IN_BLOCK))
    own = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    out = None
    for block in range(blocks):
        held = sorted((tuple(x) for x in asked.where(own == block).collect()), key=lambda x: (x[0] is not None, x))
        if held:
            found = _search_block(rows, held, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out


def oracle(k: int = BEST) -> str:
    """The same ranks of ``documents`` for each row of ``benchmark`` in SQL, document by document."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{TERM}') AS ts
               FROM documents),
    s AS (SELECT doc_id, len(ts)::BIGINT AS n, ts FROM t WHERE len(ts) > 0),
    g AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM s),
    e AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM s) GROUP BY ALL),
    d AS (SELECT term, count(*)::BIGINT AS df FROM e GROUP BY term),
    q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (
              SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                                        '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
    x AS (SELECT q.item_id, e.doc_id,
                 sum(q.times * floor(1000 * ln((2 * g.nn + 2) / (2 * d.df + 1)::DOUBLE))::BIGINT
                     * ((1000000000 * e.tf) // (1000 * e.tf + 12 * ({FLAT} + ({BY_LENGTH} * s.n * g.nn) // g.ll))))
                 ::BIGINT AS score
          FROM q JOIN e ON e.term = q.term JOIN d ON d.term = q.term JOIN s ON s.doc_id = e.doc_id CROSS JOIN g
          GROUP BY q.item_id, e.doc_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM x WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {k}"""
