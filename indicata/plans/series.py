"""Monthly indicator series derived from the landed driver tables.

These play the role of the Silver tidy table in the tests and the bench:
``orders`` gives order value per customer region, ``lineitem`` revenue per
supplier region, ``events`` activity value per event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.operators.joins import broadcast_reference
from indicata.operators.silver import VALUE_TYPE, roll_up, tidy
from indicata.plans.gold import additive
from indicata.tables import Tables

UNKNOWN_REGION = "UNKNOWN"


def nation_regions(t: Tables) -> DataFrame:
    """``n_nationkey -> region`` (nation and region are reference tables of
    fixed size: 25 and 5 rows)."""
    return (t.nation.select("n_nationkey", "n_regionkey")
            .join(broadcast_reference(t.region.select("r_regionkey", F.col("r_name").alias("region"))),
                  F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "region"))


def customer_regions(t: Tables) -> DataFrame:
    """``c_custkey -> region``; customer grows with the data, the nation map
    is broadcast into the customer scan."""
    return (t.customer.select("c_custkey", "c_nationkey")
            .join(broadcast_reference(nation_regions(t)), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", "region"))


def supplier_regions(t: Tables) -> DataFrame:
    return (t.supplier.select("s_suppkey", "s_nationkey")
            .join(broadcast_reference(nation_regions(t)), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select("s_suppkey", "region"))


def monthly(tidy_rows: DataFrame, measures: dict[str, tuple[str, bool]] | None = None) -> DataFrame:
    """Observations to one row per tidy key (partial aggregation first): summed
    where the measure is additive, else their mean (``gold.additive``)."""
    keys = ["source", "indicator", "region", "period", "measure"]
    return roll_up(tidy_rows, keys, additive(F.col("measure"), measures))


def orders_by_region(t: Tables) -> DataFrame:
    """Monthly order value per customer region (tidy contract).

    ``orders`` and ``customer`` are both large: the join is left to the planner
    (broadcast by size, else sort-merge on the customer key, where AQE splits
    a customer that holds a large share of all orders).  Summing per customer
    and month first would hardly shrink the orders and cost a shuffle more.
    The region comes from a broadcast of the 25-row nation map.
    """
    o = t.orders.select("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period"),
                        F.col("o_totalprice").cast(VALUE_TYPE).alias("v"))
    j = o.join(customer_regions(t), F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = tidy(j, "orders", "order_value",
                F.coalesce(F.col("region"), F.lit(UNKNOWN_REGION)), F.col("period"),
                "total_price", F.col("v"))
    return monthly(rows)


def orders_by_status(t: Tables) -> DataFrame:
    """Monthly order value per order status (tidy; ``region`` = ``ALL``)."""
    rows = tidy(t.orders, "orders", F.concat(F.lit("status_"), F.col("o_orderstatus")), "ALL",
                F.col("o_orderdate"), "total_price", F.col("o_totalprice"))
    return monthly(rows)


def lineitem_by_region(t: Tables) -> DataFrame:
    """Monthly net revenue per supplier region, exact decimals (see
    ``orders_by_region``)."""
    revenue = (F.col("l_extendedprice").cast("decimal(18,2)")
               * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))).cast(VALUE_TYPE)
    li = t.lineitem.select("l_suppkey", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("period"),
                           revenue.alias("v"))
    j = li.join(supplier_regions(t), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    rows = tidy(j, "lineitem", "net_revenue",
                F.coalesce(F.col("region"), F.lit(UNKNOWN_REGION)), F.col("period"),
                "revenue", F.col("v"))
    return monthly(rows)


def events_by_type(t: Tables) -> DataFrame:
    """Monthly event value per event type."""
    rows = tidy(t.events, "events", F.col("event_type"), "ALL", F.col("ts"), "value", F.col("value"))
    return monthly(rows)
