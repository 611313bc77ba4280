from collections import defaultdict

import duckdb
import pytest

from indicata.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], SCHEMA)


def water(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    """Targets by raising and stopping, step by step."""
    names = sorted(sizes, key=lambda x: (x is None, x))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    out, left, todo = {}, share * sum(sizes.values()), set(names)
    while todo:
        level = left / sum(weight[x] for x in todo)
        stop = {x for x in todo if weight[x] * level > most * sizes[x]}
        if not stop:
            return out | {x: weight[x] * level for x in todo}
        for x in stop:
            out[x] = most * sizes[x]
        left -= sum(out[x] for x in stop)
        todo -= stop
    return out


def test_targets_and_copies(spark):
    rows = [(i, "w " * (i % 37), f"s{i % 7}") for i in range(900)]
    rows += [(1000 + i, "w " * 3, "hot") for i in range(700)] + [(2000, None, None), (2001, "", "zero")]
    rows += [(5, "w " * 5, "s5")] * 4 + [(None, "a b", None), (None, "a b", None)]
    df = frame(spark, rows)
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
    goal, taken, largest = water(sizes), defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in sizes)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    mixed = mixing.mix(df)
    out = mixing.take(df, mixed)
    assert out.columns == df.columns
    assert out.count() == sum(r.copies for r in found)


def test_empty(spark):
    df = frame(spark, [])
    assert mixing.mix(df).count() == 0 and mixing.take(df, mixing.mix(df)).count() == 0


def test_oracle(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    found = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_small}/documents.parquet'")
    assert sorted(map(tuple, found)) == sorted(con.sql(mixing.oracle()).fetchall())
