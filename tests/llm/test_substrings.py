import hashlib
import random
from collections import Counter

import numpy as np

from indicata.llm import substrings, suffixes

SCHEMA = "doc_id long, text string, spans string, kept string, th string"


def brute(rows, length=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[s:s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(110), text(130)
    rows = [(i, text(r.randint(50, 200))) for i in range(20)]
    rows += [(20 + i, text(60) + passage + text(60)) for i in range(6)]
    rows += [(30 + i, other[:420 + 30 * i] + text(10)) for i in range(4)]         # cut off at different places
    rows += [(40, rows[3][1]), (41, rows[3][1][5:] + "x"), (42, "ab" * 900), (43, "b" * 1200)]
    rows += [(44, passage + " " + passage), (45, None), (46, ""), (47, "x" * 399), (48, "x" * 400)]
    rows += [(49, text(20)[:399]), (None, text(100)), (3, rows[3][1]), (3, text(100))]
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    return sorted((tuple(x) for x in substrings.digest(substrings.remove_repeats(df)).collect()), key=str)


def test_matches_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_large_groups_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substrings, "TOGETHER", 2)
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_runs_in_pieces_equal_runs_at_once(monkeypatch):
    raw = np.frombuffer(b"".join((t or "").encode() for _, t in corpus()), np.uint8)
    off = np.array([0, 1000, 1300, len(raw)])
    whole = substrings.runs(raw, off)
    monkeypatch.setattr(substrings, "AT_ONCE", 777)
    assert all((a == b).all() for a, b in zip(whole, substrings.runs(raw, off)))


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 50, 300):
        for letters in (1, 2, 4, 200):
            text = rng.integers(0, letters, n).astype(np.uint8)
            raw = text.tobytes()
            assert suffixes.suffix_array(text, n + 1).tolist() == sorted(range(n), key=lambda i: raw[i:])
