import re
from collections import Counter

import numpy as np

from indicata.llm import quality
from indicata.llm.queries import op7_quality_rules

SCHEMA = "doc_id long, text string, stats string, kept string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


TEXTS = [None, "", " \n\t", "a", "a b c a b c", "x\nx\nx \n\nx", "é ü # $ <b>|&%*> é", "a b " * 40, "\x0b\x0ca\xa0b\x85c\x1cd",
         "w1 w2 w3 w4 w1 w2 w3 w5 w2 w3 w4", "漢字 漢字 漢字 漢字", "long " * 30000]


def test_statistics(spark):
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(TEXTS)], SCHEMA)
    found = quality.judge(df, quality.DecisionList()).select(
        "row.doc_id", *[f"stats.{x}" for x in quality.STATISTICS[:5]], "base_failed", "kept").collect()
    for r in found:
        expected = brute(TEXTS[r.doc_id])
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert tuple(r)[1:] == (*expected, failed, not failed), r.doc_id
    assert quality.judge(df.where("false"), quality.DecisionList()).count() == 0


def test_list_is_learned(spark):
    rng = np.random.default_rng(0)
    n = 600
    x = {name: rng.random(n) for name in quality.FEATURES}
    bad = (x["symbols_per_word"] > 0.8) | (x["upper_per_char"] > 0.7) & (x["marks_per_word"] > 0.5)
    rules = quality.learn_list(x, bad)
    said = np.zeros(n, bool)
    for rule in rules.rules:
        said |= quality._covered(rule, x, n)
    assert np.mean(said == bad) > 0.97 and len(rules.rules) <= 6
    nothing = quality.learn_list(x, np.zeros(n, bool))
    assert nothing.rules == [] and str(nothing) == "reject nothing"
    assert quality.learn_list({k: v[:0] for k, v in x.items()}, np.zeros(0, bool)).rules == []


def test_labels(spark):
    rows = [(i, " ".join(f"plain{i} words{j}" for j in range(40)), "a", "b", "c") for i in range(40)]
    rows += [(100 + i, " ".join(f"wo{i}### rd{j}$$$" for j in range(40)), "a", "b", "c") for i in range(40)]
    df = spark.createDataFrame([*rows, rows[0], (None, rows[0][1], "a", "b", "c")], SCHEMA)
    labels = spark.createDataFrame([(r[0], int(r[0] < 100), "k") for r in rows] + [(1, None, "k"), (None, 0, "k"), (3, 1, "k")],
                                   "doc_id long, quality int, text string")
    rules = quality.learn(df, labels)
    kept = {(r.doc_id, r.kept) for r in quality.judge(df, rules).select("row.doc_id", "kept").collect()}
    assert kept == {(r[0], r[0] < 100) for r in rows} | {(None, True)}
    assert quality.learn(df, labels.where("false")).rules == []


def test_driver_tables(spark, sf_small):
    rows = op7_quality_rules(spark, sf_small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(tuple(r)[1:6] == brute(texts[r.doc_id]) for r in rows)
