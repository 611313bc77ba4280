"""Driver contract: entry smoke check, every catalog query against its DuckDB
oracle (sf0.001), and plan guards."""

import datetime as dt
import decimal
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from indicata.plans import catalog
from indicata.tables import TABLES

ORACLE = catalog.oracle_sql()
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.queries()}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["region", "period", "value", "yoy", "mom"]


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert not any(k.startswith("pipeline") for k in QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(ORACLE[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_and_no_python(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
    for node in python_nodes:
        assert node not in plan


def test_plan_guards(spark, sf_small):
    assert "TakeOrderedAndProject" in _plan(QUERIES["sample_rows"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual" in _plan(QUERIES["scope_since"](spark, sf_small))
    star = _plan(QUERIES["star_query"](spark, sf_small))
    assert "BroadcastHashJoin" in star and "SortMergeJoin" not in star
    assert "WindowGroupLimit" in _plan(QUERIES["dedup_latest"](spark, sf_small))
    cols = _plan(QUERIES["ingest_progress"](spark, sf_small))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:" in cols  # column pruning
    diff = _plan(QUERIES["version_diff"](spark, sf_small)).split("Initial Plan")[0]
    assert diff.count("Scan parquet") <= 4 and diff.count("ShuffleQueryStage") <= 1


def test_yoy_and_mom_share_one_shuffle(spark, sf_small):
    from indicata.operators.measures import with_changes
    from indicata.plans.series import orders_by_status
    from indicata.tables import Tables

    monthly = orders_by_status(Tables(spark, sf_small))
    base = monthly._jdf.queryExecution().executedPlan().toString().count("Exchange")
    both = with_changes(monthly, ["indicator"])._jdf.queryExecution().executedPlan().toString()
    assert both.count("Exchange") == base + 1
