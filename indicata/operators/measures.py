"""Derived measures on monthly series: YoY, MoM, YTD, QTD.

All four use *range* frames over a month index (``year * 12 + month - 1``),
so a missing month yields NULL instead of silently comparing with the wrong
month (a row-based ``lag`` would).  Each series is partitioned on its own
key, so the windows shuffle once on the series columns and share that
partitioning and sort (YoY and MoM share one Window exec, YTD/QTD extend the
same ordering).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_index(period: str = "period") -> Column:
    p = F.col(period)
    return F.year(p) * 12 + F.month(p) - 1


def _prior_value(series: list[str], months_back: int, value: str) -> Column:
    w = (Window.partitionBy(*series).orderBy(F.col("_midx"))
         .rangeBetween(-months_back, -months_back))
    # a row without a month (the unknown member) has no prior one
    return F.when(F.col("_midx").isNotNull(), F.first(F.col(value)).over(w))


def _change(current: Column, prior: Column, scale: int) -> Column:
    ratio = F.try_divide(current.cast("double"), F.nullif(prior.cast("double"), F.lit(0.0)))
    return F.round(ratio - F.lit(1.0), scale)


def with_yoy(df: DataFrame, series: list[str], value: str = "value", period: str = "period",
             out: str = "yoy", scale: int = 6) -> DataFrame:
    """``value / value(12 months earlier) - 1``; NULL if that month is absent or 0."""
    return (df.withColumn("_midx", month_index(period))
            .withColumn(out, _change(F.col(value), _prior_value(series, 12, value), scale))
            .drop("_midx"))


def with_mom(df: DataFrame, series: list[str], value: str = "value", period: str = "period",
             out: str = "mom", scale: int = 6) -> DataFrame:
    """``value / value(previous month) - 1``; NULL if absent or 0."""
    return (df.withColumn("_midx", month_index(period))
            .withColumn(out, _change(F.col(value), _prior_value(series, 1, value), scale))
            .drop("_midx"))


def with_changes(df: DataFrame, series: list[str], value: str = "value",
                 period: str = "period", scale: int = 6) -> DataFrame:
    """YoY and MoM in one pass (same partitioning and ordering)."""
    return (df.withColumn("_midx", month_index(period))
            .withColumn("yoy", _change(F.col(value), _prior_value(series, 12, value), scale))
            .withColumn("mom", _change(F.col(value), _prior_value(series, 1, value), scale))
            .drop("_midx"))


def _to_date(series: list[str], extra: list[Column], value: str, additive: Column | bool,
             period: str) -> Column:
    w = (Window.partitionBy(*series, *extra).orderBy(month_index(period))
         .rangeBetween(Window.unboundedPreceding, 0))
    running_sum = F.sum(F.col(value)).over(w)
    if additive is True:
        return running_sum
    running_mean = F.avg(F.col(value)).over(w)
    if additive is False:
        return running_mean
    return F.when(additive, running_sum).otherwise(running_mean)


def with_ytd(df: DataFrame, series: list[str], value: str = "value", period: str = "period",
             additive: Column | bool = True, out: str = "ytd") -> DataFrame:
    """Running total within the calendar year (running mean if not additive)."""
    p = F.col(period)
    return df.withColumn(out, _to_date(series, [F.year(p)], value, additive, period))


def with_qtd(df: DataFrame, series: list[str], value: str = "value", period: str = "period",
             additive: Column | bool = True, out: str = "qtd") -> DataFrame:
    """Running total within the calendar quarter (running mean if not additive)."""
    p = F.col(period)
    return df.withColumn(out, _to_date(series, [F.year(p), F.quarter(p)], value, additive, period))
