"""A7/A1: stored sketches merge to the profile of the whole, within their bounds."""

import random
from collections import Counter

from indicata.operators import sketches


def rows(n=20000):
    r = random.Random(3)
    return [(r.choice("abc") if i % 50 else None, r.randint(0, 5000), "w%d" % min(r.randint(0, 300), r.randint(0, 300)),
             r.choice(["", "x", None])) for i in range(n)]


def test_merged_sketches_equal_the_whole_within_bounds(spark, tmp_path):
    data = rows()
    df = spark.createDataFrame(data, "part string, number long, word string, gap string").repartition(5)
    path, columns = str(tmp_path / "sketches"), ["number", "word", "gap"]
    sketches.store(sketches.sketch(df.where("part IN ('a', 'b')"), "part", columns, top=40), path)
    old = {x for x in spark.read.parquet(path).inputFiles()}
    sketches.store(sketches.sketch(df.where("part = 'c' OR part IS NULL"), "part", columns, top=40), path)
    assert old <= set(spark.read.parquet(path).inputFiles())      # stored ones stay
    got = {r.column_name: r for r in sketches.merged(spark.read.parquet(path)).collect()}
    for i, c in enumerate(columns, 1):
        values = [x[i] for x in data if x[i] is not None]
        assert (got[c].n_rows, got[c].n_values, got[c].n_empty) == (len(data), len(values), values.count(""))
        assert (got[c].least, got[c].greatest) == (min(map(str, values)), max(map(str, values)))
        assert abs(got[c].n_distinct - len(set(values))) <= 0.06 * len(set(values)) + 1
        counts = Counter(map(str, values))
        for x in got[c].frequent:
            assert x.low <= counts[x.value] <= x.high
    assert [x.value for x in got["gap"].frequent] == [v for v, _ in sorted(Counter(
        x[3] for x in data if x[3] is not None).items(), key=lambda x: (-x[1], x[0]))]
    assert all(x.low == x.high for x in got["gap"].frequent)
    numbers = sorted(x[1] for x in data)
    for q, x in zip((0.25, 0.5, 0.75), got["number"].quantiles):
        assert numbers[int((q - 0.03) * len(numbers))] <= x <= numbers[int((q + 0.03) * len(numbers))]
    assert got["word"].quantiles is None


def test_nothing(spark):
    df = spark.createDataFrame([], "part string, number long")
    assert sketches.merged(sketches.sketch(df, "part", ["number"])).collect() == []
    one = spark.createDataFrame([("a", None)], "part string, number long")
    got = sketches.merged(sketches.sketch(one, "part", ["number"])).first()
    assert (got.n_rows, got.n_values, got.n_distinct, got.quantiles, got.frequent) == (1, 0, 0, None, None)
