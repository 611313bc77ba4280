import zlib

import duckdb
import numpy as np

from indicata.llm import toxicity
from indicata.llm.queries import op9_toxicity

SCHEMA = "doc_id long, text string, score string, predicted string"


def corpus():
    rng = np.random.default_rng(3)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    def sentence():
        return " ".join(rng.choice(words, 8))
    clean = [". ".join(sentence() for _ in range(10)) for _ in range(300)]
    bad = [". ".join([*(sentence() for _ in range(9)), f"you {rng.choice(['moron', 'scum'])} you"]) for _ in range(60)]
    return clean, bad


def test_sentences_are_located(spark):
    clean, bad = corpus()
    model = toxicity.fit(clean + bad, np.array([0] * 300 + [1] * 60))
    text = "Some words here. What a MORON, really! Others."
    rows = [(1, text), (2, None), (3, ""), (4, "!!! ... \n"), (5, "wordaa wordab. " * 20000), (None, "scum"), (1, text)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    found = toxicity.score(df, model).collect()
    assert sorted((r.doc_id or 0, r.predicted) for r in found) == [(0, 1), (1, 1), (1, 1), (2, 0), (3, 0), (4, 0), (5, 0)]
    spans = next(r.offending for r in found if r.doc_id == 1)
    assert [text[s.start:s.end] for s in spans] == [" What a MORON, really"]
    assert all(0 <= r.score <= 1 for r in found)
    assert toxicity.score(df.where("false"), model).count() == 0


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "a b c", "x", "y")], SCHEMA)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(df, labels)
    assert model.score("a b c") == 0


def test_bounds_of_the_sample(spark):
    clean, bad = corpus()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(clean + bad)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(360)], "doc_id long, toxic int")
    assert toxicity.learn(df, labels).score("moron") >= 0.5
    assert toxicity.learn(df, labels, most_chars=0).score("moron") == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in op9_toxicity(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    own = [(y, found[i].predicted) for i, y in labels if found[i].held_out]
    assert np.mean([a == b for a, b in own]) >= 0.9
