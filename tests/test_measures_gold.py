import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from indicata.operators.gold import UNKNOWN_KEY, assign_keys, calendar_from, resolve_keys
from indicata.operators.measures import with_changes, with_qtd, with_ytd
from indicata.plans.gold import build_star, derive_measures, star_by_region_month


def monthly(spark):
    """Missing month (2023-03), zero (2023-05), first year, quarter and year turns."""
    rows = []
    for y in (2022, 2023):
        for m in range(1, 13):
            if (y, m) == (2023, 3):
                continue
            v = Decimal(0) if (y, m) == (2022, 5) else Decimal(100 + m + (y - 2022) * 12)
            rows.append(("s", dt.date(y, m, 1), v, True))
    return spark.createDataFrame(rows, "series string, period date, value decimal(18,4), additive boolean")


def test_yoy_mom_gap_and_zero_rules(spark):
    got = {r.period: r for r in with_changes(monthly(spark), ["series"]).collect()}
    assert got[dt.date(2022, 6, 1)].yoy is None                    # first year
    assert got[dt.date(2023, 4, 1)].mom is None                    # previous month absent
    assert got[dt.date(2023, 5, 1)].yoy is None                    # 12 months earlier was 0
    assert got[dt.date(2022, 6, 1)].mom is None                    # previous month 0
    assert got[dt.date(2023, 6, 1)].yoy == round(118 / 106 - 1, 6)
    assert got[dt.date(2023, 1, 1)].mom == round(113 / 112 - 1, 6)  # year turn


def test_ytd_qtd_and_index_mean(spark):
    df = monthly(spark)
    out = with_qtd(with_ytd(df, ["series"]), ["series"]).collect()
    by = {r.period: r for r in out}
    assert by[dt.date(2022, 12, 1)].ytd == sum(r.value for r in out if r.period.year == 2022)
    assert by[dt.date(2023, 4, 1)].qtd == by[dt.date(2023, 4, 1)].value      # quarter turn
    mean = with_ytd(df, ["series"], additive=False).where("period = date'2022-03-01'").first().ytd
    assert float(mean) == (101 + 102 + 103) / 3


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=1000), min_size=12, max_size=12))
def test_property_december_ytd_is_year_sum(spark, values):
    rows = [("s", dt.date(2021, m + 1, 1), Decimal(v)) for m, v in enumerate(values)]
    df = spark.createDataFrame(rows, "series string, period date, value decimal(18,4)")
    dec = with_ytd(df, ["series"]).where("month(period) = 12").first().ytd
    assert dec == sum(values)


def test_surrogate_keys_stable_and_unknown(spark):
    old = spark.createDataFrame([(1, "B"), (2, "A")], "k long, name string")
    nat = spark.createDataFrame([("A",), ("C",), ("B",), ("D",)], "name string")
    keys = {r.name: r.k for r in assign_keys(nat, "k", ["name"], existing=old).collect()}
    assert keys == {"B": 1, "A": 2, "C": 3, "D": 4}
    fact = spark.createDataFrame([("A", 1.0), ("Z", 2.0)], "name string, v double")
    dim = spark.createDataFrame([(2, "A")], "k long, name string")
    got = sorted((r.k, r.v) for r in resolve_keys(fact, [(dim, ["name"], "k")]).collect())
    assert got == [(UNKNOWN_KEY, 2.0), (2, 1.0)]


def test_calendar_covers_gaps(spark):
    df = spark.createDataFrame([(dt.date(2023, 11, 1),), (dt.date(2024, 2, 1),)], "period date")
    cal = calendar_from(df).orderBy("month_start").collect()
    assert [r.calendar_key for r in cal] == [202311, 202312, 202401, 202402]
    assert [r.quarter for r in cal] == [4, 4, 1, 1]


def test_star_roundtrip_and_measures(spark):
    rows = [("orders", "ind", "EUROPE", dt.date(2024, 1, 1), "m", Decimal("10")),
            ("orders", "ind", "ASIA", dt.date(2024, 1, 1), "m", Decimal("5")),
            ("orders", "ind", "NOWHERE", dt.date(2024, 2, 1), "m", Decimal("7")),
            ("lineitem", "ind", "ASIA", dt.date(2024, 2, 1), "m", Decimal("3"))]
    tidy = spark.createDataFrame(rows, "source string, indicator string, region string, period date, "
                                       "measure string, value decimal(18,4)")
    regions = spark.createDataFrame([("ASIA",), ("EUROPE",)], "region string")
    star = build_star(tidy, regions, measures={"m": ("unit", True)})
    assert star.fact.count() == 4
    assert star.fact.where(F.col("region_key") == UNKNOWN_KEY).count() == 1
    got = sorted((r.region, str(r.period), float(r.value)) for r in star_by_region_month(star, "orders", "m").collect())
    assert got == [("ASIA", "2024-01-01", 5.0), ("EUROPE", "2024-01-01", 10.0), ("UNKNOWN", "2024-02-01", 7.0)]
    m = derive_measures(tidy, star.dim_measure).where("region = 'ASIA' and source = 'orders'").first()
    assert float(m.ytd) == 5.0 and m.yoy is None
    with pytest.raises(Exception, match="no unit known for measure m"):
        build_star(tidy, regions)


def test_dimension_attributes(spark):
    rows = [("energy", "demand", r, dt.date(2024, m, 1), k, Decimal(v)) for r, m, k, v in (
        ("Madrid", 1, "value", 10), ("Madrid", 2, "value", 30), (None, 1, "index", 5), ("Madrid", 1, "index", 10),
        ("Madrid", 2, "index", 30))]
    tidy = spark.createDataFrame(rows, "source string, indicator string, region string, period date, "
                                       "measure string, value decimal(18,4)")
    star = build_star(tidy, tidy.select("region"), parents={"Madrid": "Espana"}, indicators={"demand": ("D1", "Demand")})
    assert {r.measure: (r.unit, r.additive) for r in star.dim_measure.where("measure_key > 0").collect()} == {
        "value": ("MWh", True), "index": ("index points", False)}
    assert {(r.region, r.parent) for r in star.dim_region.collect()} == {("Madrid", "Espana"), ("UNKNOWN", "UNKNOWN")}
    named = star.dim_indicator.where("indicator = 'demand'").first()
    assert (named.code, named.name) == ("D1", "Demand")
    assert star.fact.where("region_key = -1").count() == 1      # a NULL region is the unknown member
    ytd = {(r.measure, r.period.month): float(r.ytd) for r in derive_measures(tidy, star.dim_measure).where(
        "region = 'Madrid'").collect()}
    assert ytd == {("value", 1): 10, ("value", 2): 40, ("index", 1): 10, ("index", 2): 20}
