"""Gold layer: dimensions, surrogate keys, fact and star queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.sinks.files import materialize

UNKNOWN_KEY = -1


def calendar_from(df: DataFrame, period_col: str = "period") -> DataFrame:
    """Calendar dimension covering every month from the first to the last
    period in ``df`` (gaps included).

    The bounds are one global aggregate (one row); the months between them
    are generated with ``sequence`` — no join, no driver round trip.
    """
    bounds = df.agg(F.min(period_col).alias("lo"), F.max(period_col).alias("hi"))
    months = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start"))
    return calendar_columns(months)


def calendar_columns(months: DataFrame) -> DataFrame:
    """Add key and parts to a ``month_start`` column."""
    m = F.col("month_start")
    return months.select(
        (F.year(m) * 100 + F.month(m)).alias("calendar_key"),
        m.alias("month_start"),
        F.year(m).alias("year"),
        F.quarter(m).alias("quarter"),
        F.month(m).alias("month"),
        F.date_format(m, "MMMM").alias("month_name"),
    )


def assign_keys(natural: DataFrame, key_col: str, order_cols: list[str],
                existing: DataFrame | None = None) -> DataFrame:
    """Surrogate keys for a dimension.

    Keys already in ``existing`` are kept; new natural keys get the numbers
    after ``max(existing key)``, without gaps, in natural-key order (see
    ``number_densely``).  A NULL natural key is the unknown member: it gets no
    key here and resolves to ``-1``.
    """
    distinct = natural.select(*order_cols).dropna().distinct()
    if existing is None:
        return number_densely(distinct, order_cols, key_col)
    old = existing.select(key_col, *order_cols)
    new = distinct.join(old.select(*order_cols), on=order_cols, how="left_anti")
    base = existing.agg(F.coalesce(F.max(key_col), F.lit(0))).first()[0]
    return old.unionByName(number_densely(new, order_cols, key_col, base).select(key_col, *order_cols))


def number_densely(rows: DataFrame, order_cols: list[str], key_col: str, after: int = 0) -> DataFrame:
    """``rows`` (distinct in ``order_cols``) numbered from ``after + 1`` in
    order, without gaps and without one task that sees them all.

    Rows are dealt out by ranges, sorted and written with their place in their
    partition; the sizes of the partitions (one row each) are summed up in
    order, and each row adds its partition's offset."""
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()), "numbered")   # partition << 33 | place
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # at most one row per shuffle partition
    key = F.lit(after + 1) + F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "_part").withColumn(key_col, key.cast("bigint")).drop(
        "_at", "_part", "_offset")


def resolve_key(fact: DataFrame, dim: DataFrame, on: list[str], key_col: str) -> DataFrame:
    """Replace natural key columns ``on`` by the dimension key ``key_col``.

    Left join: a fact row never disappears; an unmatched or NULL natural key
    gets the unknown member ``-1``.  The planner decides on a broadcast from
    its size estimate and AQE re-decides from the real size at runtime.
    """
    joined = fact.join(dim.select(key_col, *on), on=on, how="left")
    return joined.withColumn(key_col, F.coalesce(F.col(key_col), F.lit(UNKNOWN_KEY).cast("bigint"))
                             ).drop(*on)


def resolve_keys(fact: DataFrame, dims: list[tuple[DataFrame, list[str], str]]) -> DataFrame:
    """``resolve_key`` for every ``(dim, natural_cols, key_col)``."""
    return reduce(lambda acc, d: resolve_key(acc, *d), dims, fact)
