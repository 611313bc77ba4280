"""M2 — Silver per source, all to the tidy contract
``source, indicator, region, period, measure, value decimal(18,4)``.

Each builder returns one typed frame with a row for every landed observation
and its ``status``: ``ok``, ``blank`` (empty or placeholder value: no
observation), ``reject`` (value or period that doesn't parse, listed in
``rejects``) or ``superseded`` (a later load holds the same observation).
Nothing is dropped or collapsed here: observations of one tidy key (several
delegations of a region, several rows of a month) are rolled up in Gold, by
the additive flag of their measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.operators.silver import VALUE_TYPE, cleanse_text, history, map_values, parse_as, superseded
from indicata.functions.text import fold_name
from indicata.sources.cells import label_cells

TIDY_KEY = ["source", "indicator", "region", "period", "measure"]
#: What one energy observation is told apart by, whatever request it answers.
ENERGY_KEY = ["geo_name", "series_type", "datetime"]
UNMAPPED = "UNMAPPED"


def month_from_text(text: Column) -> Column:
    """Month start from ``YYYY-MM…`` (first 10 characters, offsets ignored:
    ``2014-01-01T00:00:00+01:00`` stays January) or ``YYYYMmm``; NULL for
    anything else, a month of 13 included."""
    t = F.trim(text)
    month = F.when(t.rlike(r"^\d{4}M\d{2}$"), F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 6, 2),
                                                       F.lit("-01"))).otherwise(F.substring(t, 1, 10))
    return F.trunc(month.try_cast("date"), "month")


def typed(df: DataFrame, source: str, indicator: Column, region: Column, raw_period: Column, measure: Column,
          raw_value: Column, detail: Column | None = None, decimal_comma: bool = False,
          loaded_at: Column | None = None, outdated: Column | None = None) -> DataFrame:
    """Observations on the tidy contract with ``detail`` (what tells apart the
    observations of one key), the landed texts, ``rejects`` (column, raw,
    target), ``rounded`` (more than four decimals), ``loaded_at`` and
    ``status``; ``outdated`` ones are superseded, whatever they hold."""
    raw = cleanse_text(raw_value)
    wide = parse_as(raw, "decimal(38,18)", decimal_comma=decimal_comma)
    df = df.select(
        F.lit(source).alias("source"), indicator.cast("string").alias("indicator"),
        region.cast("string").alias("region"), month_from_text(raw_period).alias("period"),
        measure.cast("string").alias("measure"), wide.try_cast(VALUE_TYPE).alias("value"),
        (detail if detail is not None else F.lit(None)).cast("string").alias("detail"),
        raw_period.cast("string").alias("raw_period"), raw.alias("raw_value"), wide.alias("_wide"),
        (loaded_at if loaded_at is not None else F.lit(None)).cast("timestamp").alias("loaded_at"),
        (outdated if outdated is not None else F.lit(False)).alias("_outdated"))

    def failed(column: str, raw_column: str, target: str) -> Column:
        return F.when(F.col(column).isNull(), F.struct(
            F.lit(column).alias("column"), F.col(raw_column).alias("raw"), F.lit(target).alias("target")))
    blank = F.col("raw_value").isNull()
    rejects = F.filter(F.array(failed("value", "raw_value", VALUE_TYPE), failed("period", "raw_period", "month")),
                       lambda x: x.isNotNull())
    df = df.withColumn("rejects", F.when(~blank, rejects))
    return df.withColumn("rounded", F.coalesce(F.col("value") != F.col("_wide"), F.lit(False))).withColumn(
        "status", F.when(F.col("_outdated"), F.lit("superseded")).when(blank, F.lit("blank"))
        .when(F.size("rejects") > 0, F.lit("reject")).otherwise(F.lit("ok"))).drop("_wide", "_outdated")


def tidy_rows(observations: DataFrame) -> DataFrame:
    """The accepted observations on the tidy contract."""
    return observations.where(F.col("status") == "ok").select(*TIDY_KEY, "value")


def reject_rows(observations: DataFrame) -> DataFrame:
    """One row per text that failed: the observation's key texts, column, raw, target."""
    return observations.where(F.col("status") == "reject").select(
        "source", "indicator", "region", "measure", "detail", "raw_period", F.explode("rejects").alias("r")).select(
        "source", "indicator", "region", "measure", "detail", "raw_period", "r.*")


def silver_energy(bronze: DataFrame) -> DataFrame:
    """Energy Bronze -> one observation per point and measure (``value`` and
    ``percentage``).

    Where Bronze has a load time (``_loaded_at``), the points of a region,
    series and timestamp that come from an older load than its latest one are
    superseded: a full-history re-pull revises what it answers again and
    leaves the rest."""
    if "_loaded_at" in bronze.columns:
        marked = bronze.withColumn("_outdated", superseded(bronze, ENERGY_KEY, "_loaded_at"))
    else:
        marked = bronze.withColumns({"_loaded_at": F.lit(None).cast("timestamp"), "_outdated": F.lit(False)})
    long = marked.select("series_type", "geo_name", "datetime", "_loaded_at", "_outdated", F.explode(F.array(
        F.struct(F.lit("value").alias("measure"), F.col("value").alias("raw")),
        F.struct(F.lit("percentage").alias("measure"), F.col("percentage").alias("raw")))).alias("m"))
    return typed(long, "energy", F.col("series_type"), F.col("geo_name"), F.col("datetime"), F.col("m.measure"),
                 F.col("m.raw"), loaded_at=F.col("_loaded_at"), outdated=F.col("_outdated"))


def energy_history(observations: DataFrame) -> DataFrame:
    """Older versions of revised energy observations: ``source, indicator,
    region, raw_period, measure, raw_values, valid_from, valid_to``."""
    keys = ["source", "indicator", "region", "raw_period", "measure"]
    found = history(observations, keys, "loaded_at", ["raw_value"])
    return found.select(*keys, F.col("versions.raw_value").alias("raw_values"), "valid_from", "valid_to")


def silver_delimited(bronze: DataFrame, source: str, region_col: str, indicator_col: str,
                     period_col: str, value_col: str, measure: str = "index",
                     decimal_comma: bool = True) -> DataFrame:
    """Delimited Bronze (IPI/IPC) -> one observation per row.  Names of the
    four columns come from configuration since headers differ per publication."""
    return typed(bronze, source, cleanse_text(F.col(f"`{indicator_col}`")), cleanse_text(F.col(f"`{region_col}`")),
                 F.col(f"`{period_col}`"), F.lit(measure), F.col(f"`{value_col}`"), decimal_comma=decimal_comma)


def crosstab_cells(cells: DataFrame, header_rows: DataFrame, label_col: int = 1) -> DataFrame:
    """Workbook cells below the header, each with its row label (the text in
    ``label_col`` of the same row) and its column header name.  Cells read
    back from a grid bring their ``label``; others are joined to it."""
    labeled = label_cells(cells, header_rows)
    if "label" in cells.columns:
        return labeled.where(F.col("col_idx") != label_col)
    labels = cells.where(F.col("col_idx") == label_col).select(
        "file", "sheet", "row_idx", F.col("text").alias("label"))
    return (labeled.where(F.col("col_idx") != label_col)
            .join(labels, ["file", "sheet", "row_idx"], "left"))


def silver_tax(cells: DataFrame, header_rows: DataFrame, delegation_map: DataFrame,
               periods: str | dict[str, str], label_col: int = 1) -> tuple[DataFrame, DataFrame]:
    """Tax crosstab -> observations per delegation (``detail``), and the
    delegations without a region, whose observations stay under ``UNMAPPED``.
    Delegations are found whatever their case, accents and articles; one with
    two regions fails the job.

    ``periods``: the month that a workbook reports, one for all or by file."""
    x = crosstab_cells(cells, header_rows, label_col).withColumn("delegation", cleanse_text("label"))
    mapped = map_values(x, delegation_map, "delegation", "region", fold_name)
    if isinstance(periods, str):
        period = F.lit(periods)
    else:
        by_file = F.create_map(*[F.lit(v) for kv in periods.items() for v in kv])
        period = F.coalesce(F.try_element_at(by_file, F.col("file")), F.raise_error(
            F.concat(F.lit("workbook without a period: "), F.col("file"))).cast("string"))
    out = typed(mapped, "tax", F.lit("tax_revenue"), F.coalesce(F.col("region"), F.lit(UNMAPPED)), period,
                F.col("header"), F.col("text"), F.col("delegation"))
    unmapped = mapped.where(F.col("region").isNull()).groupBy("delegation").agg(F.count(F.lit(1)).alias("n_rows"))
    return out, unmapped


def silver_construction(cells: DataFrame, header_rows: DataFrame, label_col: int = 1,
                        region: str = "ES") -> DataFrame:
    """Construction workbooks (first and continuation files of each agent)
    -> observations.  The row label is the period; each header is a measure;
    the indicator is the contracting agent.  First and continuation files
    become one series by plain union."""
    x = crosstab_cells(cells, header_rows, label_col)
    return typed(x, "construction", F.col("contracting_agent"), F.lit(region), F.col("label"), F.col("header"),
                 F.col("text"), F.col("file"))
