import math

import numpy as np
from pyspark.sql import functions as F

from indicata.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def brute(rows, asks, k):
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, done = set(), set()
    for i, q in ok:
        if not asks(i) or (i, tuple(q)) in done:
            continue
        done.add((i, tuple(q)))
        all_ = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ok if j != i)
        out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(all_[:k]))
    return out


def test_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, .2, 8)]) for i in range(300)]
    rows[7] = (7, rows[3][1])                      # equal vectors tie
    rows += [(400, None), (401, [None, 1.0]), (500, [float("nan"), 0.0]), (501, [float("inf"), 1.0]), (None, [1.0])]
    rows += [(600, []), (602, [0.0] * 8), (604, [0.5, 0.0, -0.25]), (606, [1.0] * 12)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    found = {tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0).collect()}
    assert found == brute(rows, lambda i: i % 20 == 0, 10)


def test_repeated_rows_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0])] * 3 + [(1, [3.0, 0.0]), (2, [3.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    assert sorted(map(tuple, topk.search(df, F.col("vec_id") == 0).collect())) == [
        (0, 1, 1, 3 * 1024 * 1024), (0, 2, 2, 3 * 1024 * 1024)]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.search(df, F.col("vec_id") % 2 == 0).count() == 0


def test_blocks_split(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATES_IN_BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 4) / 4]) for i in range(120)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    found = {tuple(r) for r in topk.search(df, F.col("vec_id") % 10 == 0, k=5).collect()}
    assert found == brute(rows, lambda i: i % 10 == 0, 5)
