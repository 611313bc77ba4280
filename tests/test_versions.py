"""K4/J5: changes touch only changed partitions and appear at once; J1: dense keys without one task."""

import os

import pytest
from pyspark.sql import functions as F

from indicata.operators.gold import assign_keys, number_densely
from indicata.sinks import versions


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    root = str(tmp_path / "table")
    df = spark.createDataFrame([(i, f"v{i}", "2024-0%d" % (1 + i % 4), i % 2) for i in range(40)],
                               "k int, v string, month string, half int")
    versions.overwrite(df, root, ["month", "half"])
    return root


def test_a_merge_reads_and_writes_touched_partitions_only(spark, table):
    before = versions.current(spark, table)
    was = rows(versions.read(spark, table))
    files = {x for x in versions.read(spark, table).inputFiles()}
    updates = spark.createDataFrame([("new", 1, "2024-02", 1), ("added", 99, "2024-02", 1), ("odd", 7, "a=b/c", 1),
                                     ("none", 8, None, None)], "v string, k int, month string, half int")
    after = versions.merge(updates, table, ["k", "month", "half"])
    assert after.number == before.number + 1
    kept = {n: f for n, f in after.folders.items() if before.folders.get(n) == f}
    assert len(kept) == len(before.folders) - 1 and len(after.folders) == len(before.folders) + 2
    now = rows(versions.read(spark, table))
    assert now == sorted([x for x in was if x[0] != 1] + [(1, "new", "2024-02", 1), (99, "added", "2024-02", 1),
                                                          (7, "odd", "a=b/c", 1), (8, "none", None, None)], key=str)
    assert rows(versions.read(spark, table, before)) == was          # the older version stays readable
    left = set(versions.read(spark, table).inputFiles()) & files
    assert left == {x for x in files if "month=2024-02/half=1" not in x}
    # the plan of the merge scans the touched partition alone
    part = versions.read(spark, table, before, ["month=2024-02/half=1"])
    assert {os.path.basename(os.path.dirname(x)) for x in part.inputFiles()} == {"half=1"} and part.count() == 10


def test_nothing_is_seen_before_the_swap(spark, table, monkeypatch):
    was, files = rows(versions.read(spark, table)), versions._Files(spark, table)
    updates = spark.createDataFrame([(1, "new", "2024-02", 1)], "k int, v string, month string, half int")

    def killed(*_):
        raise RuntimeError("killed")
    monkeypatch.setattr(versions._Files, "publish", killed)
    with pytest.raises(RuntimeError, match="killed"):
        versions.merge(updates, table, ["k", "month", "half"])
    monkeypatch.undo()
    assert rows(versions.read(spark, table)) == was
    assert len(files.children(files.path(table, "data"))) == 2      # what the killed change wrote; no version names it
    versions.merge(updates, table, ["k", "month", "half"])          # again, whole
    assert (1, "new", "2024-02", 1) in rows(versions.read(spark, table))
    assert len(versions.vacuum(spark, table)) == 1
    assert (1, "new", "2024-02", 1) in rows(versions.read(spark, table))


def test_the_slower_of_two_changes_fails(spark, table, monkeypatch):
    updates = spark.createDataFrame([(1, "new", "2024-02", 1)], "k int, v string, month string, half int")
    files, before = versions._Files(spark, table), versions.current(spark, table)
    versions.merge(updates, table, ["k", "month", "half"])
    with pytest.raises(versions.ConflictError):
        versions._swap(files, table, before, versions.read(spark, table, before, ["month=2024-01/half=0"]))
    assert versions.current(spark, table).number == before.number + 1


def test_replace_is_truncate_and_load_of_its_partitions(spark, table):
    df = spark.createDataFrame([(500, "only", "2024-02", 1)], "k int, v string, month string, half int")
    versions.replace(df, table)
    got = versions.read(spark, table)
    assert [tuple(r) for r in got.where("month = '2024-02'").collect()] == [(500, "only", "2024-02", 1)]
    assert got.count() == 31


def test_keys_must_tell_the_partition_and_be_unique(spark, table):
    one = spark.createDataFrame([(1, "new", "2024-02", 1)], "k int, v string, month string, half int")
    with pytest.raises(ValueError, match="tell the partition"):
        versions.merge(one, table, ["k"])
    with pytest.raises(Exception, match="several updates of one key"):
        versions.merge(one.union(one), table, ["k", "month", "half"])
    assert versions.merge(one.limit(0), table, ["k", "month", "half"]).number == 1
    with pytest.raises(FileNotFoundError):
        versions.merge(one, table + "-none", ["k", "month", "half"])


def test_dense_keys_without_one_task(spark):
    names = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"), (F.col("id") % 7).alias("n"))
    keyed = assign_keys(names.union(names), "k", ["n", "name"])
    got = [(r.n, r.name, r.k) for r in keyed.orderBy("k").collect()]
    assert [x[2] for x in got] == list(range(1, 5001)) and [x[:2] for x in got] == sorted(x[:2] for x in got)
    old = keyed.where("k <= 100")
    more = {(r.n, r.name): r.k for r in assign_keys(names, "k", ["n", "name"], existing=old).collect()}
    assert more == {x[:2]: x[2] for x in got}
    assert number_densely(names.limit(0), ["name"], "k").count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = number_densely(names, ["name"], "k", 10)
        assert placed.select(F.shiftright(F.col("k"), 40)).count() == 5000
        assert placed.agg(F.min("k"), F.max("k")).first()[:] == (11, 5010)
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    single = plan.split("SinglePartition")[1:]
    assert len(single) == 1 and "HashAggregate(keys=[_part" in single[0]   # sums of partition sizes, not keys
