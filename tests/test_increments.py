"""M3: measures of changed months equal a full rebuild; other years are neither read nor written."""

import random
from datetime import date
from decimal import Decimal

import pytest

from indicata.plans import increments
from indicata.plans.gold import derive_measures
from indicata.sinks import versions

SCHEMA = "source string, indicator string, region string, measure string, period date, value decimal(18,4)"


@pytest.fixture
def tables(spark, tmp_path):
    r = random.Random(6)
    rows = {("s", "i", region, measure, date(y, m, 1)): Decimal(r.randint(1, 999))
            for region in ("A", "B", None) for measure in ("add", "mean") for y in range(2018, 2025)
            for m in range(1, 13) if r.random() < 0.9}
    flags = spark.createDataFrame([("add", True), ("mean", False)], "measure string, additive boolean")
    roots = str(tmp_path / "monthly"), str(tmp_path / "measures")
    increments.build(frame(spark, rows), flags, *roots)
    return rows, flags, roots


def frame(spark, rows):
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)


def told(df):
    return sorted(str(r) for r in df.collect())


def test_changed_months_equal_a_rebuild(spark, tables):
    rows, flags, roots = tables
    changes = {("s", "i", "A", "add", date(2020, 12, 1)): Decimal(5), ("s", "i", None, "mean", date(2021, 5, 1)): Decimal(7),
               ("s", "i", "B", "add", date(2025, 1, 1)): Decimal(11), ("s", "i", "new", "add", date(2021, 3, 1)): Decimal(3)}
    same = next(k for k in rows if k[2] == "B" and k[4].year == 2018)
    before = [versions.current(spark, x) for x in roots]
    assert increments.apply_changes(frame(spark, changes | {same: rows[same]}), flags, *roots) == 4
    want = derive_measures(frame(spark, rows | changes), flags)
    assert told(versions.read(spark, roots[1]).drop("year")) == told(want)
    assert told(versions.read(spark, roots[0]).drop("year")) == told(frame(spark, rows | changes))
    after = [versions.current(spark, x) for x in roots]
    for old, new, years in zip(before, after, ({2020, 2021, 2025}, {2020, 2021, 2022, 2025, 2026})):
        written = {int(n[5:]) for n, f in new.folders.items() if old.folders.get(n) != f}
        assert written <= years and 2018 not in written and 2023 not in written


def test_nothing_changed_writes_nothing(spark, tables):
    rows, flags, roots = tables
    assert increments.apply_changes(frame(spark, dict(list(rows.items())[:50])), flags, *roots) == 0
    assert [versions.current(spark, x).number for x in roots] == [1, 1]


def test_a_run_killed_between_the_tables_is_repeated(spark, tables, monkeypatch):
    rows, flags, roots = tables
    change = {("s", "i", "A", "add", date(2019, 2, 1)): Decimal(1)}
    plain = versions.merge

    def once(df, root, keys):
        if root == roots[0]:
            raise RuntimeError("killed")
        return plain(df, root, keys)
    monkeypatch.setattr(versions, "merge", once)
    with pytest.raises(RuntimeError, match="killed"):
        increments.apply_changes(frame(spark, change), flags, *roots)
    monkeypatch.undo()
    assert increments.apply_changes(frame(spark, change), flags, *roots) == 1
    assert told(versions.read(spark, roots[1]).drop("year")) == told(derive_measures(frame(spark, rows | change), flags))


def test_frontier(spark):
    one = frame(spark, {("s", "i", "A", "add", date(2020, 11, 1)): Decimal(1)})
    assert sorted(str(r.period) for r in increments.frontier(one).collect()) == [
        "2020-11-01", "2020-12-01", "2021-11-01"]
    one = frame(spark, {("s", "i", "A", "add", date(2020, 12, 1)): Decimal(1)})
    assert sorted(str(r.period) for r in increments.frontier(one).collect()) == [
        "2020-12-01", "2021-01-01", "2021-12-01"]


def test_only_needed_years_are_read(spark, tables, monkeypatch):
    rows, flags, roots = tables
    read, plain = [], versions.read
    monkeypatch.setattr(versions, "read", lambda s, root, *a, **k: read.append((root, k.get("partitions") or (
        a[1] if len(a) > 1 else None))) or plain(s, root, *a, **k))
    increments.apply_changes(frame(spark, {("s", "i", "A", "add", date(2022, 6, 1)): Decimal(1)}), flags, *roots)
    assert read and all(p is not None for _, p in read)
    assert {x for _, p in read for x in p} <= {"year=2021", "year=2022", "year=2023"}
