"""Catalog: Gold — dimensions, keyed fact, star query, derived measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.operators.gold import assign_keys, calendar_from
from indicata.operators.measures import with_mom, with_qtd, with_ytd, with_yoy
from indicata.operators.silver import consolidate
from indicata.plans import series
from indicata.plans.catalog import (EVENTS_BY_TYPE_SQL, LINEITEM_BY_REGION_SQL,
                                    ORDERS_BY_REGION_SQL, ORDERS_BY_STATUS_SQL, query, tables)
from indicata.plans.gold import build_star, clustered, region_yoy, star_by_region_month
from indicata.session import scratch_path


def _star(spark, base):
    t = tables(spark, base)
    return build_star(series.orders_by_region(t), t.region.select(F.col("r_name").alias("region")))


def flagship(spark, base):
    """Year-over-year change of order value per region and month, through
    the star schema (fact + dimensions)."""
    return region_yoy(_star(spark, base), "orders", "total_price")


_CHANGE = "ROUND(CAST(value AS DOUBLE) / NULLIF(CAST({p} AS DOUBLE), 0) - 1, 6)"

STAR_SQL = f"""
WITH m AS ({ORDERS_BY_REGION_SQL}),
r AS (
  SELECT region, period, CAST(SUM(value) AS DECIMAL(18,4)) AS value,
         year(period) * 12 + month(period) - 1 AS midx
  FROM m GROUP BY region, period),
w AS (
  SELECT region, period, value,
    first_value(value) OVER (PARTITION BY region ORDER BY midx RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS p12,
    first_value(value) OVER (PARTITION BY region ORDER BY midx RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS p1
  FROM r)
SELECT region, period, value, {_CHANGE.format(p="p12")} AS yoy, {_CHANGE.format(p="p1")} AS mom FROM w
"""

query("star_query", STAR_SQL)(flagship)


@query("dim_calendar", """
WITH b AS (SELECT min(CAST(date_trunc('month', o_orderdate) AS DATE)) AS lo,
                  max(CAST(date_trunc('month', o_orderdate) AS DATE)) AS hi FROM orders),
m AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b)
SELECT CAST(year(month_start) * 100 + month(month_start) AS INTEGER) AS calendar_key,
       month_start, CAST(year(month_start) AS INTEGER) AS year,
       CAST(quarter(month_start) AS INTEGER) AS quarter, CAST(month(month_start) AS INTEGER) AS month,
       monthname(month_start) AS month_name
FROM m
""")
def dim_calendar(spark, base):
    t = tables(spark, base)
    months = t.orders.select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period"))
    return calendar_from(months, "period").select(
        F.col("calendar_key").cast("int"), "month_start", F.col("year").cast("int"),
        F.col("quarter").cast("int"), F.col("month").cast("int"), "month_name")


@query("fact_with_keys", f"""
WITH m AS ({ORDERS_BY_REGION_SQL}),
dr AS (SELECT r_name AS region, ROW_NUMBER() OVER (ORDER BY r_name) AS region_key FROM region),
ds AS (SELECT source, ROW_NUMBER() OVER (ORDER BY source) AS source_key FROM (SELECT DISTINCT source FROM m)),
di AS (SELECT indicator, ROW_NUMBER() OVER (ORDER BY indicator) AS indicator_key FROM (SELECT DISTINCT indicator FROM m)),
dm AS (SELECT measure, ROW_NUMBER() OVER (ORDER BY measure) AS measure_key FROM (SELECT DISTINCT measure FROM m))
SELECT CAST(COALESCE(di.indicator_key, -1) AS BIGINT) AS indicator_key,
       CAST(COALESCE(dr.region_key, -1) AS BIGINT) AS region_key,
       CAST(year(m.period) * 100 + month(m.period) AS INTEGER) AS calendar_key,
       CAST(COALESCE(dm.measure_key, -1) AS BIGINT) AS measure_key,
       CAST(COALESCE(ds.source_key, -1) AS BIGINT) AS source_key,
       m.value
FROM m
LEFT JOIN dr ON m.region = dr.region
LEFT JOIN ds ON m.source = ds.source
LEFT JOIN di ON m.indicator = di.indicator
LEFT JOIN dm ON m.measure = dm.measure
""")
def fact_with_keys(spark, base):
    return _star(spark, base).fact


def _status_series(spark, base):
    return series.orders_by_status(tables(spark, base)).select("indicator", "period", "value")


def _range_sql(months: int, name: str) -> str:
    return f"""
WITH m AS ({ORDERS_BY_STATUS_SQL}),
w AS (SELECT indicator, period, value,
        first_value(value) OVER (PARTITION BY indicator ORDER BY year(period) * 12 + month(period)
                                 RANGE BETWEEN {months} PRECEDING AND {months} PRECEDING) AS p
      FROM m)
SELECT indicator, period, value, {_CHANGE.format(p="p")} AS {name} FROM w
"""


@query("yoy", _range_sql(12, "yoy"))
def yoy(spark, base):
    return with_yoy(_status_series(spark, base), ["indicator"])


@query("mom", _range_sql(1, "mom"))
def mom(spark, base):
    return with_mom(_status_series(spark, base), ["indicator"])


def _to_date_sql(extra: str, name: str, agg: str = "SUM", cast: str = "DECIMAL(18,4)") -> str:
    return f"""
WITH m AS ({ORDERS_BY_STATUS_SQL})
SELECT indicator, period, value,
       CAST({agg}(value) OVER (PARTITION BY indicator, year(period){extra}
                              ORDER BY year(period) * 12 + month(period)
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {cast}) AS {name}
FROM m
"""


@query("ytd", _to_date_sql("", "ytd"))
def ytd(spark, base):
    return with_ytd(_status_series(spark, base), ["indicator"]).withColumn(
        "ytd", F.col("ytd").cast("decimal(18,4)"))


@query("qtd", _to_date_sql(", quarter(period)", "qtd"))
def qtd(spark, base):
    return with_qtd(_status_series(spark, base), ["indicator"]).withColumn(
        "qtd", F.col("qtd").cast("decimal(18,4)"))


@query("ytd_index", f"""
WITH m AS ({ORDERS_BY_STATUS_SQL})
SELECT indicator, period, value,
       ROUND(CAST(AVG(value) OVER (PARTITION BY indicator, year(period)
                              ORDER BY year(period) * 12 + month(period)
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 6) AS ytd
FROM m
""")
def ytd_index(spark, base):
    """YTD of a non-additive measure (an index): running mean in the year."""
    out = with_ytd(_status_series(spark, base), ["indicator"], additive=False)
    return out.withColumn("ytd", F.round(F.col("ytd").cast("double"), 6))


@query("fact_union", f"""
{ORDERS_BY_REGION_SQL}
UNION ALL {LINEITEM_BY_REGION_SQL}
UNION ALL {EVENTS_BY_TYPE_SQL}
""")
def fact_union(spark, base):
    """Three sources into one tidy fact contract."""
    t = tables(spark, base)
    return consolidate([series.orders_by_region(t), series.lineitem_by_region(t),
                        series.events_by_type(t)])


# ── J6: a slice of the written fact ───────────────────────────────────────

def written_star(spark, base):
    """The star of three sources, its fact written by source and clustered by month."""
    t = tables(spark, base)
    monthly = consolidate([series.orders_by_region(t), series.lineitem_by_region(t), series.events_by_type(t)])
    star = build_star(monthly, t.region.select(F.col("r_name").alias("region")))
    path = scratch_path(spark, "fact")
    clustered(star.fact).write.partitionBy("source_key").parquet(path)
    star.fact = spark.read.schema(star.fact.schema).parquet(path)
    return star


@query("star_pruned", f"""
SELECT region, period, value FROM ({LINEITEM_BY_REGION_SQL})
WHERE period BETWEEN DATE '1994-06-01' AND DATE '1995-05-01'
""")
def star_pruned(spark, base):
    """Twelve months of one source from the written fact: other sources' files and other months are not read."""
    return star_by_region_month(written_star(spark, base), "lineitem", "revenue", ("1994-06", "1995-05"))


# ── J1: dense surrogate keys over a dimension that grows with the data ────

@query("dense_keys", """
WITH d AS (SELECT DISTINCT o_orderpriority, o_custkey FROM orders),
old AS (SELECT *, row_number() OVER (ORDER BY o_orderpriority, o_custkey) AS k FROM d WHERE o_custkey % 3 = 0),
new AS (SELECT *, row_number() OVER (ORDER BY o_orderpriority, o_custkey) + (SELECT max(k) FROM old) AS k
        FROM d WHERE o_custkey % 3 <> 0)
SELECT * FROM old UNION ALL SELECT * FROM new
""")
def dense_keys(spark, base):
    """Keys of (priority, customer), numbered in two runs: those of every third customer first."""
    t, order = tables(spark, base), ["o_orderpriority", "o_custkey"]
    first = assign_keys(t.orders.where("o_custkey % 3 = 0"), "k", order)
    return assign_keys(t.orders, "k", order, existing=first).select("k", *order)
