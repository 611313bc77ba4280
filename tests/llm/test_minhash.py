import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from indicata.llm import graph, minhash

SCHEMA = "doc_id long, text string, component string, kept string, sig string"
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute(rows, percent=85):
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(FOLD).split()
        sets.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    holders, parent = defaultdict(list), list(range(len(rows)))
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), doc)
        least[find(i)] = min(least[find(i)], doc)
    return sorted((doc, len(sets[i]), least[find(i)], doc == least[find(i)]) for i, (doc, _) in enumerate(rows))


def corpus():
    r = random.Random(2)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n)]
    rows, passage = [], words(60)
    for i in range(40):
        rows.append((i, " ".join(words(r.randint(3, 120)))))
    base = words(150)
    for i in range(60):   # near copies with one to four changed words: some reach the base, some only others
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = "changed" + str(r.random())[2:6]
        rows.append((100 - i, " ".join(w)))
    rows += [(200 + i, " ".join(passage + words(25))) for i in range(30)]         # a passage in common only
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "One  TWO"), (305, "one two three")]
    rows += [(306, "a b c d e"), (307, "A b\nc d e"), (308, "a b c d f"), (5, rows[5][1]), (5, rows[5][1])]
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)
    found = minhash.near_duplicates(df, **more)
    return df, found


def test_matches_brute_force(spark):
    rows = corpus()
    _, found = run(spark, rows)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id", "kept").collect())) == brute(rows)


def test_small_blocks_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "IN_LIST", 7)
    monkeypatch.setattr(minhash, "IN_FAMILY", 5)
    monkeypatch.setattr(minhash, "SENT", 0)
    rows = corpus()
    df, found = run(spark, rows, percent=80, shared=12)
    expected = brute(rows, 80)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id", "kept").collect())) == expected
    kept = minhash.keep_one(df, found)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({doc for doc, _, component, _ in expected if doc == component})


def test_empty(spark):
    df, found = run(spark, [])
    assert found.count() == 0 and minhash.keep_one(df, found).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, graph.components(df).collect())) == [(i, 0) for i in range(41)] + [(100, 100), (101, 100)]
    assert graph.components(df.where(F.lit(False))).count() == 0


def test_oracle(spark, sf_small):
    import duckdb
    from indicata.llm.queries import op4_near_duplicates
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_small}/documents.parquet'")
    found = op4_near_duplicates(spark, sf_small).collect()
    assert sorted(map(tuple, found)) == sorted(con.sql(minhash.oracle()).fetchall())
