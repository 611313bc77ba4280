import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from indicata.llm import trie

SCHEMA = "doc_id long, text string, s string, sig string, component string, n string"
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(rows):
    out = []
    for _, t in rows:
        w = (t or "").encode().translate(FOLD).split()
        out.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows, percent=80):
    sets = sets_of(rows)
    holders, parent, links = defaultdict(list), list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)], links[i]) for i, (doc, _) in enumerate(rows))


def corpus():
    r = random.Random(11)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n)]
    rows, passage = [], words(70)
    for i in range(60):
        rows.append((i, " ".join(words(r.randint(1, 150)))))
    for size in (8, 30, 150, 700):   # near copies with changed, added and lost words, around the bound
        base = words(size)
        for _ in range(50):
            w = list(base)
            for _ in range(r.randint(0, max(1, size // 30))):
                w[r.randrange(len(w))] = "changed" + str(r.random())[2:6]
            w = w[:len(w) - r.choice([0, 0, size // 8, size // 4])] + words(r.choice([0, 0, 0, size // 9]))
            rows.append((1000 + len(rows), " ".join(w)))
    rows += [(5000 - i, " ".join(passage + words(r.randint(5, 60)))) for i in range(80)]   # mostly a passage in common
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "One  TWO"), (305, "one two three")]
    rows += [(306, "a b c d e f g h"), (307, "A b\nc d e f g h i"), (308, "a b c d f"), (5, rows[5][1]), (5, "x")]
    return rows + [(6000 + i, rows[70][1]) for i in range(20)]


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA).repartition(6)
    return sorted(tuple(x) for x in trie.join(df, **more).collect())


def test_links_equal_brute_force(spark):
    rows = corpus()
    got, want = run(spark, rows), brute(rows)
    assert got == want
    assert len({x[2] for x in want if x[3]}) > 5 and max(x[3] for x in want) > 20


def test_small_blocks_frequent_shingles_and_another_bound(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(trie, "IN_FAMILY", 12)
    monkeypatch.setattr(trie, "SHINGLES_IN_FAMILY", 2000)
    monkeypatch.setattr(trie, "PIECE", 5)
    monkeypatch.setattr(trie, "SENT", 3)
    assert run(spark, rows, percent=85) == brute(rows, 85)


def test_runs_of_shingles_across_batches(monkeypatch):
    monkeypatch.setattr(trie, "FREQUENT", 8)
    r = random.Random(1)
    rows = [(t, s) for t in range(60) for s in sorted(r.sample(range(100), r.choice([1, 1, 2, 5, 7, 8, 9, 40])))]
    count = Counter(t for t, _ in rows)
    want = [(s, t, 4 if count[t] >= 8 else count[t].bit_length() - 1) for t, s in rows if count[t] > 1]
    for size in (1, 3, 10, 1000):
        batches = [pa.RecordBatch.from_pydict({"t": [x[0] for x in part], "s": [x[1] for x in part]},
                                              schema=pa.schema([("t", pa.int64()), ("s", pa.int64())]))
                   for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        got = [tuple(x.values()) for out in trie._shared(iter(batches)) for x in out.to_pylist()]
        assert got == want


def test_lists_join_whatever_could_be_similar():
    r = random.Random(8)
    for trial in range(60):
        rows = []
        for t in range(r.randint(1, 5)):
            for _ in range(r.choice([1, 2, 3, 20, 60])):
                n = r.randint(5, 60)
                rows.append((t, n, r.randint(n * 4 // 5 - 1, n * 5 // 4), r.randint(1, 10 ** 9)))
        rows.sort()
        size = r.choice([1, 2, 7, 1000])
        names = ("t", "n", "reach", "s")
        batches = [pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows[k:k + size]], pa.int64()) for i in range(4)],
                                              names) for k in range(0, len(rows), size)]
        links = [tuple(x.values()) for out in trie._joined_lists(iter(batches)) for x in out.to_pylist()]

        def groups(pairs):
            parent = {x[3]: x[3] for x in rows}

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x
            for a, b in pairs:
                parent[find(a)] = find(b)
            return {frozenset(x for x in parent if find(x) == y) for y in map(find, parent)}
        could = [(x[3], y[3]) for x in rows for y in rows if x[0] == y[0] and x[1] <= y[1] <= x[2] and x[1] <= y[2]]
        assert groups(links) == groups(could)
        assert len(links) <= len(rows)


def test_walks_find_every_overlap_that_links():
    r = np.random.default_rng(4)
    sets = [np.unique(r.choice(400, r.integers(1, 300))) for _ in range(40)]
    base = np.unique(r.choice(400, 250))
    sets += [np.unique(np.concatenate([base[r.random(len(base)) > 0.05], r.choice(400, 8)])) for _ in range(60)]
    sets += [base, base[:-1], base[1:], base[:200], base[:1]]
    sets = list({x.tobytes(): x for x in sets}.values())
    tree, mark = trie.Trie(sets), np.zeros(500, bool)
    links = pruned = 0
    for x in sets:
        found = tree.overlaps(x, 80, mark)
        assert not mark.any()
        for y, n in zip(sets, found.tolist()):
            both = len(np.intersect1d(x, y))
            assert n in (-1, both)
            pruned += n < 0
            if 100 * both >= 80 * (len(x) + len(y) - both):
                assert n == both
                links += 1
    assert links > 1000 and pruned > 1000
    assert len(tree.ends) < sum(len(x) for x in sets) / 8   # common beginnings are stored once


def test_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, " ")]) == [(1, 0, 1, 0), (2, 0, 2, 0)]
