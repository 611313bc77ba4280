"""Query catalog over the landed driver tables.

Each entry is ``name -> (builder(spark, base_dir) -> DataFrame, oracle SQL)``.
The SQL is an independent formulation of the same result for DuckDB over the
same Parquet tables; column names and types are aliased identically on both
sides.  Money is summed as exact decimals, ratios are doubles rounded to 6
places, and every pick-one uses a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indicata.tables import Tables

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None):
    """Register ``builder`` under ``name`` with its oracle SQL (or None)."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_all() -> None:
    # Importing the modules registers their queries.
    from indicata.plans import catalog_bronze, catalog_gold, catalog_layers, catalog_silver  # noqa: F401


def tables(spark: SparkSession, base: str) -> Tables:
    return Tables(spark, base)


# ── SQL fragments shared by several oracles ───────────────────────────────

ORDERS_BY_REGION_SQL = """
  SELECT 'orders' AS source, 'order_value' AS indicator,
         COALESCE(r.r_name, 'UNKNOWN') AS region,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS period,
         'total_price' AS measure,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS value
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL
"""

ORDERS_BY_STATUS_SQL = """
  SELECT 'orders' AS source, 'status_' || o_orderstatus AS indicator, 'ALL' AS region,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS period, 'total_price' AS measure,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS value
  FROM orders GROUP BY ALL
"""

LINEITEM_BY_REGION_SQL = """
  SELECT 'lineitem' AS source, 'net_revenue' AS indicator,
         COALESCE(r.r_name, 'UNKNOWN') AS region,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS period, 'revenue' AS measure,
         CAST(SUM(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2))
                       * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS value
  FROM lineitem l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL
"""

EVENTS_BY_TYPE_SQL = """
  SELECT 'events' AS source, event_type AS indicator, 'ALL' AS region,
         CAST(date_trunc('month', ts) AS DATE) AS period, 'value' AS measure,
         CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS value
  FROM events GROUP BY ALL
"""
