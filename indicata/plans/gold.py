"""Gold build: dimensions, keyed fact, star queries and derived measures.

Dimensions are small by construction (regions, months, sources, indicators,
measures); each, the calendar included, carries an unknown member ``-1`` so
that every fact row resolves and the star query can use inner joins.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.operators.gold import UNKNOWN_KEY, assign_keys, calendar_from, resolve_keys
from indicata.operators.measures import with_changes
from indicata.sinks.files import materialize, materialize_all

UNKNOWN_NAME = "UNKNOWN"

# Fixed values (ours): measures with their unit and whether they add up over months.  A measure that a run brings
# and that is listed neither here nor in its configuration is an error, not a mean.
MEASURES = {
    "index": ("index points", False),
    "value": ("MWh", True),
    "percentage": ("share", False),
    "total_price": ("currency", True),
    "revenue": ("currency", True),
}


def additive(measure: Column, measures: dict[str, tuple[str, bool]] | None = None) -> Column:
    """Whether a measure adds up, from the fixed measures and ``measures``
    (a literal map); NULL for one that neither lists."""
    known = {m: flag for m, (_, flag) in (MEASURES | (measures or {})).items()}
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), measure)


@dataclass
class Star:
    fact: DataFrame
    dim_region: DataFrame
    dim_calendar: DataFrame
    dim_source: DataFrame
    dim_indicator: DataFrame
    dim_measure: DataFrame


def with_unknown(dim: DataFrame, key_col: str) -> DataFrame:
    """Add the unknown member row (key -1, every text column 'UNKNOWN').

    The row is built from ``range(1)`` so the planner keeps exact size
    statistics for the dimension (a local Python list would hide them and
    turn every later dimension join into a shuffle join).
    """
    one = dim.sparkSession.range(1)
    row = [F.lit(UNKNOWN_KEY).cast(f.dataType).alias(f.name) if f.name == key_col
           else (F.lit(UNKNOWN_NAME) if f.dataType.simpleString() == "string" else F.lit(None))
           .cast(f.dataType).alias(f.name)
           for f in dim.schema.fields]
    return dim.unionByName(one.select(*row))


def with_attributes(dim: DataFrame, key: str, attributes: dict[str, dict], types: dict[str, str],
                    required: bool = False) -> DataFrame:
    """Descriptive columns of a dimension from ``attributes[natural key][column]``
    (a literal map: reference data of fixed size); ``required``: a member
    without them fails the job."""
    for column, kind in types.items():
        entries = {k: v[column] for k, v in attributes.items() if v.get(column) is not None}
        known = F.create_map(*[F.lit(x) for kv in entries.items() for x in kv]) if entries else None
        value = F.try_element_at(known, F.col(key)) if entries else F.lit(None)
        if required:
            value = F.coalesce(value, F.raise_error(F.concat(
                F.lit(f"no {column} known for {key} "), F.col(key))).cast(kind))
        dim = dim.withColumn(column, value.cast(kind))
    return dim


def build_dims(tidy_monthly: DataFrame, region_names: DataFrame, existing: dict[str, DataFrame] | None = None,
               measures: dict[str, tuple[str, bool]] | None = None, parents: dict[str, str] | None = None,
               indicators: dict[str, tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Dimensions for a tidy monthly table; ``region_names`` has ``region``.

    ``measures``: measure -> (unit, additive), beside the fixed ones;
    ``parents``: region -> region it is part of; ``indicators``: indicator ->
    (code, name), the indicator itself where none is given.

    ``existing``: the previous run's dimensions; their keys are kept and new
    natural keys are numbered after them, so keys are stable across runs.
    """
    existing = existing or {}

    def prev(name: str, key: str):
        d = existing.get(name)
        return d.where(F.col(key) != UNKNOWN_KEY) if d is not None else None

    known = {m: {"unit": u, "additive": a} for m, (u, a) in (MEASURES | (measures or {})).items()}
    natural = {"region": region_names, "source": tidy_monthly, "indicator": tidy_monthly, "measure": tidy_monthly}
    with ThreadPoolExecutor(len(natural)) as pool:   # each numbering is a small job of its own
        keyed = {n: pool.submit(assign_keys, rows, f"{n}_key", [n], prev(f"dim_{n}", f"{n}_key"))
                 for n, rows in natural.items()}
    dims = {f"dim_{n}": done.result() for n, done in keyed.items()} | {
        "dim_calendar": calendar_from(tidy_monthly, "period")}
    dims["dim_region"] = with_attributes(dims["dim_region"], "region", {
        k: {"parent": v} for k, v in (parents or {}).items()}, {"parent": "string"})
    dims["dim_measure"] = with_attributes(dims["dim_measure"], "measure", known,
                                          {"unit": "string", "additive": "boolean"}, required=True)
    named = {k: {"code": c, "name": n} for k, (c, n) in (indicators or {}).items()}
    dims["dim_indicator"] = with_attributes(dims["dim_indicator"], "indicator", named,
                                            {"code": "string", "name": "string"})
    own = {c: F.coalesce(F.col(c), F.col("indicator")) for c in ("code", "name")}
    dims["dim_indicator"] = dims["dim_indicator"].withColumns(own)
    return dims


def keyed_fact(tidy_monthly: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Tidy rows -> ``indicator_key, region_key, calendar_key, measure_key,
    source_key, value`` (unmatched natural keys -> -1, never dropped)."""
    cal = dims["dim_calendar"].select("calendar_key", F.col("month_start").alias("period"))
    fact = resolve_keys(tidy_monthly, [
        (dims["dim_indicator"], ["indicator"], "indicator_key"),
        (dims["dim_region"], ["region"], "region_key"),
        (cal, ["period"], "calendar_key"),
        (dims["dim_measure"], ["measure"], "measure_key"),
        (dims["dim_source"], ["source"], "source_key"),
    ])
    return fact.select(F.col("indicator_key").cast("bigint"), F.col("region_key").cast("bigint"),
                       F.col("calendar_key").cast("int"), F.col("measure_key").cast("bigint"),
                       F.col("source_key").cast("bigint"), "value")


def build_star(tidy_monthly: DataFrame, region_names: DataFrame, written: bool = False,
               existing: dict[str, DataFrame] | None = None, **attributes) -> Star:
    """Dimensions and keyed fact from a tidy monthly table.

    The tidy table feeds five dimensions and the fact; unless it is already a
    written table (``written=True``) it is written once first, so it is
    computed once rather than once per consumer.  ``existing``: the previous
    run's dimensions (keys carried over); ``attributes`` go to ``build_dims``.
    """
    if not written:
        tidy_monthly = materialize(tidy_monthly, "silver_monthly")
    # Dimensions are written once too: the fact joins then see their real
    # (small) file sizes, so the planner's own size check broadcasts them —
    # computed in-plan they would be estimated as large as the Silver table
    # and joined by shuffle on keys with a handful of values.
    dims = materialize_all(build_dims(tidy_monthly, region_names, existing, **attributes))
    fact = keyed_fact(tidy_monthly, dims)
    return Star(
        fact=fact,
        dim_region=with_unknown(dims["dim_region"], "region_key"),
        dim_calendar=with_unknown(dims["dim_calendar"], "calendar_key"),
        dim_source=with_unknown(dims["dim_source"], "source_key"),
        dim_indicator=with_unknown(dims["dim_indicator"], "indicator_key"),
        dim_measure=with_unknown(dims["dim_measure"], "measure_key"),
    )


def clustered(fact: DataFrame) -> DataFrame:
    """The fact as it is to be written, partitioned by ``source_key``: rows
    dealt out by ranges of (source, month, region), so that each file holds a
    run of months, whose bounds its footer tells; a source of any size spreads
    over as many tasks as it needs."""
    order = ["source_key", "calendar_key", "region_key"]
    return fact.repartitionByRange(*order).sortWithinPartitions(*order)


def month_key(month: str) -> int:
    """``YYYY-MM`` as a calendar key."""
    year, number = month.split("-")[:2]
    return int(year) * 100 + int(number)


def star_by_region_month(star: Star, source: str, measure: str, months: tuple[str, str] | None = None) -> DataFrame:
    """Star query: one source and measure, summed per region and month, of all
    months or of those from the first to the last given (``YYYY-MM``).

    On a written fact the filtered source dimension prunes its partitions
    while the query runs, and the bounds of the months, which calendar keys
    follow, are pushed down to the scan.

    Dimensions are filtered first; the planner broadcasts them from their size
    estimate (re-checked by AQE at runtime), so the fact is scanned once,
    joined map side, and partially aggregated before the single shuffle on
    ``(region, period)``.
    """
    src = star.dim_source.where(F.col("source") == source).select("source_key")
    mea = star.dim_measure.where(F.col("measure") == measure).select("measure_key")
    reg = star.dim_region.select("region_key", "region")
    cal = star.dim_calendar.select("calendar_key", F.col("month_start").alias("period"))
    fact = star.fact
    if months:
        fact = fact.where(F.col("calendar_key").between(*map(month_key, months)))
    f = (fact.join(src, "source_key").join(mea, "measure_key")
         .join(reg, "region_key").join(cal, "calendar_key"))
    return f.groupBy("region", "period").agg(F.sum("value").cast("decimal(18,4)").alias("value"))


def region_yoy(star: Star, source: str, measure: str) -> DataFrame:
    """Year-over-year (and month-over-month) change per region and month."""
    return with_changes(star_by_region_month(star, source, measure), ["region"]) \
        .select("region", "period", "value", "yoy", "mom")


def derive_measures(tidy_monthly: DataFrame, dim_measure: DataFrame) -> DataFrame:
    """All four derived measures per series (source, indicator, region,
    measure): YoY, MoM, YTD, QTD.  ``dim_measure`` tells which measures are
    additive: those are summed to date, the others averaged; a measure that it
    doesn't know fails the job."""
    from indicata.operators.measures import with_qtd, with_ytd

    series_cols = ["source", "indicator", "region", "measure"]
    flags = dim_measure.select("measure", "additive")  # a handful of written rows: the planner broadcasts them
    unknown = F.raise_error(F.concat(F.lit("measure without additive flag: "), F.col("measure"))).cast("boolean")
    df = tidy_monthly.join(flags, "measure", "left").withColumn("additive", F.coalesce(F.col("additive"), unknown))
    flag = F.col("additive")
    df = with_changes(df, series_cols)
    df = with_ytd(df, series_cols, additive=flag)
    df = with_qtd(df, series_cols, additive=flag)
    return df.select(*series_cols, "period", "value", "yoy", "mom",
                     F.col("ytd").cast("decimal(18,4)").alias("ytd"),
                     F.col("qtd").cast("decimal(18,4)").alias("qtd"))
