"""M3/W1-W4 — derived measures for changed months only.

A changed month touches its own row, the changes of the next month and of the
same month a year later, and what is summed up to date in the rest of its
quarter and year.  Only these rows are computed again, from the months that
they need, and merged into the written measures; both tables are versioned and
partitioned by year, so other years are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.operators.joins import prefixed, same_keys
from indicata.plans.gold import derive_measures
from indicata.sinks import versions
from indicata.sinks.files import materialize

SERIES = ["source", "indicator", "region", "measure"]
ROW = [*SERIES, "period", "year"]


def by_year(df: DataFrame) -> DataFrame:
    """With the year of the period, which the tables are partitioned by."""
    return df.withColumn("year", F.year("period"))


def build(monthly: DataFrame, dim_measure: DataFrame, monthly_root: str, measures_root: str) -> None:
    """Both tables whole: what ``apply_changes`` starts from."""
    versions.overwrite(by_year(monthly.select(*SERIES, "period", "value")), monthly_root, ["year"])
    whole = versions.read(monthly.sparkSession, monthly_root).drop("year")
    versions.overwrite(by_year(derive_measures(whole, dim_measure)), measures_root, ["year"])


def frontier(changed: DataFrame) -> DataFrame:
    """``series…, period`` of all rows whose measures depend on a changed (series, period); months that have no row
    are among them."""
    month = F.col("period")
    rest = F.sequence(month, F.make_date(F.year(month), F.lit(12), F.lit(1)), F.expr("interval 1 month"))
    later = F.array(F.add_months(month, 1), F.add_months(month, 12))
    return changed.select(*SERIES, F.explode(F.array_union(rest, later)).alias("period")).distinct()


def _partitions(years: list[int], reach: tuple[int, ...] = (0,)) -> list[str]:
    return sorted({f"year={y + d}" for y in years for d in reach})


def _only(df: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` with keys (null-safe) that ``few`` has; how ``few`` is sent is the planner's choice by size."""
    return df.join(prefixed(few.select(*keys).distinct(), keys), same_keys(keys), "left_semi")


def apply_changes(updates: DataFrame, dim_measure: DataFrame, monthly_root: str, measures_root: str) -> int:
    """Merge months (``series…, period, value``) into the monthly table and bring the measures up to date; the number
    of months that really changed.

    A month with the value that it had changes nothing.  The measures are
    published before the months: a run that was killed in between finds the
    same changes again and repeats the same rows.  Periods are month starts
    and never null."""
    spark: SparkSession = updates.sparkSession
    updates = materialize(by_year(updates.select(*SERIES, "period", "value")), "month_updates")
    years = [r.year for r in updates.select("year").distinct().collect()]   # at most the years that there are
    now = versions.read(spark, monthly_root, partitions=_partitions(years))
    known = now.select(*[F.col(c).alias(f"_other_{c}") for c in ROW], F.col("value").alias("_before"), F.lit(True).alias(
        "_known"))
    both = updates.join(known, same_keys(ROW), "left")
    changed = materialize(both.where(F.col("_known").isNull() | ~F.col("value").eqNullSafe(F.col("_before"))).select(
        *ROW, "value"), "month_changes")
    n = changed.count()
    if not n:
        return 0
    touched = materialize(by_year(frontier(changed)), "month_frontier")
    years = [r.year for r in touched.select("year").distinct().collect()]
    # what the touched rows need: their years to date, and for the changes the year before
    base = versions.read(spark, monthly_root, partitions=_partitions(years, (0, -1)))
    rest = base.join(prefixed(changed.select(*ROW), ROW), same_keys(ROW), "left_anti")
    months = _only(rest, changed, SERIES).unionByName(changed).drop("year")
    measures = _only(by_year(derive_measures(months, dim_measure)), touched, ROW)
    versions.merge(measures, measures_root, ROW)
    versions.merge(changed, monthly_root, ROW)
    return n
