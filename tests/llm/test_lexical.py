import math
import random
import re
from collections import Counter

from indicata.llm import lexical

SCHEMA = "doc_id long, text string, item_id string, score string, term string, bag string, m string"
ITEMS = "item_id long, text string, item string, h1 string"


def words(text):
    return [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=20):
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(x for _, b, _ in bags for x in b)
    out = []
    for item, text in set(items):
        ranked, asked = [], Counter(words(text)).items()
        for doc, bag, n in bags:
            m = 75 + 25 * n * n_docs // total
            score = sum(n_times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                        * (1000000000 * bag[x] // (1000 * bag[x] + 12 * m)) for x, n_times in asked if x in bag)
            if score > 0:
                ranked.append((-score, doc is not None, doc or 0))
        out += [(item, r + 1, doc if there else None, -s) for r, (s, there, doc) in enumerate(sorted(ranked)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*x, "i", "s", "t", "b", "m") for x in docs], SCHEMA).repartition(5)
    q = spark.createDataFrame([(*x, "i", "h") for x in items], ITEMS)
    return sorted((tuple(x) for x in lexical.search(d, q, **more).collect()), key=str)


def corpus():
    r = random.Random(13)
    names = ["Ärger", "über", "x1", "A", "the", "of", "12", "naïve", "日本", "deep", "sea", "Rare", "kELVINK"]
    docs = [(i, " ".join(r.choices(names, range(len(names), 0, -1), k=r.randint(0, 30)))) for i in range(300)]
    docs += [(1000 + i, "the Deep_sea, of x1") for i in range(80)] + [(900 - i, "The deep-sea of X1!") for i in range(80)]
    docs += [(2000, None), (2001, ""), (2002, " .,-\x7f"), (None, "deep rare"), (2003, "deep " * 70000 + "rare"),
             (5, docs[5][1]), (5, docs[5][1]), (5, "deep sea"), (2004, "unrelated words")]
    items = [(0, "The deep sea"), (1, "rare Rare über"), (2, None), (3, ""), (4, " ?! "), (5, "notfound"),
             (None, "x1 of the"), (7, "日本 naïve ärger Ärger"), (7, "sea"), (0, "The deep sea"), (9, "kelvinK"),
             (8, "the " * 3000)]
    return docs, items


def test_ranks_equal_brute_force(spark):
    docs, items = corpus()
    assert run(spark, docs, items) == brute(docs, items)


def test_items_in_several_blocks_and_few_cells(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(lexical, "IN_BLOCK", 4000)
    assert run(spark, docs, items, k=3) == brute(docs, items, 3)


def test_large_scores_stay_exact(spark):
    docs = [(i, "a b") for i in range(3)] + [(9, "c")] + [(20 + i, "d") for i in range(2000)]
    items = [(1, "a " * 3_000_000)]   # scores beyond what doubles hold
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    assert run(spark, docs, []) == []
    assert run(spark, [], items) == []
    assert run(spark, docs, [(1, None), (2, " ")]) == []
