"""M1 — the four Bronze loads, each ``landing -> all-string DataFrame``.

Every load keeps the landed values as text, adds ``_ingestion_timestamp``
(one stamp per run) and the source (file name or API path), and never drops
a row silently: malformed input is either a job failure (strict) or a
separate quarantine frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.operators.bronze import width_violations
from indicata.sources.jdbc import STAGING_WIDTH, table_count, table_sample, write_staging
from indicata.sources.cells import to_grid
from indicata.sources.csv_text import bronze_from_delimited, overlong_rows, read_delimited_files, well_formed
from indicata.sources.json_docs import energy_bronze, parse_documents
from indicata.sources.manifest import tag_with_manifest
from indicata.sinks.files import materialize
from indicata.sources.workbook import legacy_text, read_xlsx_cells, xlsx_text

# The worksheet that holds the tax crosstab.
TAX_SHEET = "datos_delegaciones"


def bronze_delimited(spark: SparkSession, landing: str, run_ts: str, sep: str = ";",
                     multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Delimited text (IPI/IPC), each file by its own header -> (Bronze rows,
    whole records of overlong rows to quarantine)."""
    raw = read_delimited_files(spark, landing, sep=sep, multiline=multiline)
    return bronze_from_delimited(well_formed(raw), run_ts), overlong_rows(raw)


def stage_delimited(spark: SparkSession, landing: str, run_ts: str, url: str, table: str,
                    properties: dict | None = None, key_cols: list[str] | None = None,
                    width: int = STAGING_WIDTH, empty_as_null: bool = True,
                    text_type: str = "VARCHAR") -> dict[str, DataFrame]:
    """Delimited text -> Bronze -> staging table, then validated.

    Values wider than the staging columns are found *before* the load; if
    any exist the load fails with a sample of them.  After
    the load: row count against the source (``OK``/``MISMATCH``) and a
    5-row sample read back in key order.
    """
    bronze, overlong = bronze_delimited(spark, landing, run_ts)
    keys = key_cols or [bronze.columns[0]]
    too_wide = width_violations(bronze, keys, width)
    out = {"bronze": bronze, "overlong": overlong, "too_wide": too_wide}
    wide = too_wide.limit(5).collect()
    if wide:
        raise ValueError(f"values wider than {width} characters, nothing loaded: {wide}")
    write_staging(bronze, url, table, properties, width=width, empty_as_null=empty_as_null, text_type=text_type)
    rows, staged = F.count(F.lit(1)).cast("bigint"), table_count(spark, url, table, properties)
    out["count_check"] = bronze.agg(rows.alias("source_rows")).select(
        "source_rows", F.lit(staged).cast("bigint").alias("target_rows"),
        F.when(F.col("source_rows") == staged, F.lit("OK")).otherwise(F.lit("MISMATCH")).alias("status"))
    out["sample"] = table_sample(spark, url, table, keys, 5, properties)
    return out


def bronze_energy(payloads: DataFrame, run_ts: str, api_path: str, strict: bool = True) -> DataFrame:
    """Landed JSON payloads ``(geo_name, year, body)``, with ``_loaded_at``
    where it is known -> Energy Bronze."""
    context = ["geo_name", *(["_loaded_at"] if "_loaded_at" in payloads.columns else [])]
    points = parse_documents(payloads, context=context, strict=strict)
    return energy_bronze(points, run_ts, api_path)


def _grid_bronze(cells: DataFrame, run_ts: str, width: int | None, extra: list[str]) -> DataFrame:
    if width is None:
        cells = materialize(cells, "workbook_cells")  # the width and the grid read one decode of the workbooks
    grid = to_grid(cells, width=width, keys=("file", "sheet", *extra))
    data = [c for c in grid.columns if c.startswith("col_")]
    return grid.select(*data, *extra, F.lit(run_ts).alias("_ingestion_timestamp"),
                       F.col("file").alias("_source_file"), F.col("row_idx").alias("_row_number"))


def bronze_construction(spark: SparkSession, workbooks: str | DataFrame, manifest: DataFrame,
                        run_ts: str, width: int | None = None) -> DataFrame:
    """Construction workbooks (first sheet) -> positional grid tagged with the
    manifest's agent and continuation flag.  Integral numbers lose ``.0``
    (legacy reader rule).  ``workbooks``: a folder of XLSX files or an
    already-extracted cell table."""
    cells = read_xlsx_cells(spark, workbooks, sheet_index=0) if isinstance(workbooks, str) else workbooks
    cells = legacy_text(cells)
    tagged = tag_with_manifest(cells, manifest.select(
        "file_id", F.col("agent").alias("contracting_agent"), "is_continuation"), "file")
    return _grid_bronze(tagged, run_ts, width, ["contracting_agent", "is_continuation"])


def bronze_tax(spark: SparkSession, workbooks: str | DataFrame, run_ts: str,
               sheet: str = TAX_SHEET, width: int | None = None) -> DataFrame:
    """Tax workbook, sheet by name -> positional grid (cached formula values,
    ``''`` for empty cells, Python text of numbers/booleans/dates)."""
    cells = read_xlsx_cells(spark, workbooks, sheet=sheet) if isinstance(workbooks, str) \
        else workbooks.where(F.col("sheet") == sheet)
    return _grid_bronze(xlsx_text(cells), run_ts, width, [])


__all__ = ["stage_delimited", "bronze_delimited", "bronze_energy", "bronze_construction", "bronze_tax", "TAX_SHEET"]
