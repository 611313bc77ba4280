"""Exact top-k search by inner product: term-at-a-time accumulation over inverted blocks.

Candidates are cut into blocks; a block holds, for each dimension, the posting list of its rows with a value there.
Queries are sparse rows, in blocks too.  For each pair of blocks, every term of a query scatters its weighted postings
into a dense array of integer scores, the best k are selected by partition, and the k of all blocks are merged.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES_IN_BLOCK = 4096
QUERIES_IN_BLOCK = 1024


def usable(vector: Column) -> Column:
    """Not null and without null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False))


def _pack(ids: np.ndarray, dims: np.ndarray, rows: np.ndarray, values: np.ndarray) -> bytes:
    return struct.pack("<qq", len(ids), len(dims)) + b"".join(
        np.ascontiguousarray(x, t).tobytes() for x, t in ((ids, "<i8"), (values, "<i8"), (dims, "<i4"), (rows, "<i4")))


def _unpack(raw: bytes):
    n, m = struct.unpack_from("<qq", raw)
    at = 16
    out = []
    for count, kind in ((n, "<i8"), (m, "<i8"), (m, "<i4"), (m, "<i4")):
        x = np.frombuffer(raw, kind, count, at)
        out.append(x)
        at += x.nbytes
    return out


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows(id, vector array<bigint>)`` as blocks of at most ``size`` rows: their ids and non-zero entries."""
    def run(batches):
        def flush():
            ids = np.concatenate([x[0] for x in held])
            counts = np.concatenate([x[1] for x in held])
            values = np.concatenate([x[2] for x in held])
            owner = np.repeat(np.arange(len(ids)), counts)
            dims = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
            some = values != 0
            return pa.RecordBatch.from_arrays(
                [pa.array([_pack(ids, dims[some], owner[some], values[some])], pa.binary()),
                 pa.array([len(ids)], pa.int32())], ["block", "n"])

        held, count = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                vectors = part.column("vector")
                got = (part.column("id").to_numpy(zero_copy_only=False),
                       vectors.value_lengths().to_numpy(zero_copy_only=False),
                       vectors.flatten().to_numpy(zero_copy_only=False))
                if held and count + part.num_rows > size:
                    yield flush()
                    held, count = [], 0
                held.append(got)
                count += part.num_rows
        if held:
            yield flush()

    return rows.mapInArrow(run, "block binary, n int")


def _scored(queries: bytes, candidates: bytes, k: int):
    """Query row, query id, candidate id and score of the k best candidates of each query in one pair of blocks."""
    q_ids, q_values, q_dims, q_rows = _unpack(queries)
    c_ids, c_values, c_dims, c_rows = _unpack(candidates)
    if len(q_values) and len(c_values):
        widest = int(np.bincount(q_rows).max())
        if widest * int(np.abs(q_values).max()) * int(np.abs(c_values).max()) >= 1 << 63:
            raise ArithmeticError("inner products of these vectors don't fit 64-bit integers")
    by_id = np.argsort(c_ids, kind="stable")  # so that among equal scores the first are the smaller ids
    place = np.empty_like(by_id)
    place[by_id] = np.arange(len(by_id))
    c_ids, c_rows = c_ids[by_id], place[c_rows]
    order = np.lexsort((c_rows, c_dims))
    c_dims, c_rows, c_values = c_dims[order], c_rows[order], c_values[order]
    starts = np.searchsorted(c_dims, np.arange(int(c_dims[-1]) + 2 if len(c_dims) else 1))
    postings = [(None if b - a == len(c_ids) else c_rows[a:b], c_values[a:b]) for a, b in zip(starts, starts[1:])]
    q_starts = np.searchsorted(q_rows, np.arange(len(q_ids) + 1))  # entries come in order of rows
    score, scaled = np.empty(len(c_ids), np.int64), np.empty(len(c_ids), np.int64)
    for i in range(len(q_ids)):
        score[:] = 0
        for j in range(q_starts[i], q_starts[i + 1]):
            if q_dims[j] >= len(postings):
                continue
            rows, values = postings[q_dims[j]]
            if rows is None:  # every row of the block has this dimension
                np.multiply(values, q_values[j], out=scaled)
                score += scaled
            elif len(rows):
                score[rows] += values * q_values[j]
        own = slice(*np.searchsorted(c_ids, [q_ids[i], q_ids[i] + 1]))
        there = np.delete(score, own) if own.start != own.stop else score
        ids = np.delete(c_ids, own) if own.start != own.stop else c_ids
        if len(there) > k:
            least = np.partition(there, len(there) - k)[len(there) - k]
            above = np.flatnonzero(there > least)
            best = np.concatenate([above, np.flatnonzero(there == least)[:k - len(above)]])
        else:
            best = np.arange(len(there))
        yield i, int(q_ids[i]), ids[best], there[best]


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
           scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row with ``is_query``, its ``k`` highest integer inner products
    with all rows of another id (all, if fewer), ties to the smaller id.

    Components x become floor(scale * x), x as double; where lengths differ, missing components count as 0.  Rows with
    a null id, a null vector or one with null or non-finite components take no part; empty vectors score 0 with all.
    Rows that repeat an id are candidates of their own; equal rows are one query.  No queries or no candidates: no rows.  Products
    beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`")
    rows = vectors.where(F.col(f"`{key}`").isNotNull() & usable(v)).select(
        F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("vector"))
    asking = rows.where("asks").select("id", "vector").distinct()
    n_blocks = max(1, math.ceil(rows.where("asks").count() / QUERIES_IN_BLOCK))
    spread = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, math.ceil(spread / n_blocks))  # parts of the candidates, so that few query blocks still spread
    asking = asking.repartition(n_blocks, F.xxhash64("id", "vector"))
    queries = _blocks(asking, QUERIES_IN_BLOCK).select(
        F.xxhash64("block").alias("q_block"), F.col("block").alias("queries"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    blocks = _blocks(rows.select("id", "vector"), CANDIDATES_IN_BLOCK).select(
        F.col("block").alias("candidates"), F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"))
    # A stated query set against all rows, in blocks: candidates meet the blocks of queries, not single queries.
    tasks = n_blocks * salts
    pairs = blocks.repartition(max(1, min(tasks, spread)), "salt").join(
        queries.repartition(max(1, min(tasks, spread)), "salt"), "salt").select("q_block", "queries", "candidates")

    def run(batches):
        for batch in batches:
            for name, q, c in zip(*(batch.column(x) for x in ("q_block", "queries", "candidates"))):
                found = list(_scored(q.as_py(), c.as_py(), k))
                counts = [len(x[2]) for x in found]
                if sum(counts):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(sum(counts), name.as_py())),
                        pa.array(np.repeat([x[0] for x in found], counts).astype(np.int32)),
                        pa.array(np.repeat([x[1] for x in found], counts)),
                        pa.array(np.concatenate([x[2] for x in found])),
                        pa.array(np.concatenate([x[3] for x in found]))],
                        ["q_block", "q_row", "query_id", "vec_id", "score"])

    best = pairs.mapInArrow(run, "q_block bigint, q_row int, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("q_block", "q_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def oracle(k: int = 10, every: int = 100) -> str:
    """The same search of ``embeddings`` in SQL, pair by pair."""
    return f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
