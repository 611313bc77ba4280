"""S5/R3/A3 — workbook cells as a long table, and what is built from it.

Cell table: ``file, sheet, row_idx, col_idx (1-based), text``, one row per
non-empty cell.  Everything downstream stays long (one row per cell) until
the very end, so no step needs a whole sheet in one task:

* ``to_grid`` — the positional Bronze grid ``col_01…col_NN`` with blank
  rows and cells kept (a row spine per sheet, cells packed per row);
* ``fill_headers`` — merged header cells forward-filled along the row;
* ``header_names`` / ``label_cells`` — multi-row headers joined with
  ``" / "`` and attached to the data cells;
* ``grid_shape`` — rows, columns and cells per sheet;
* ``wider_than_header`` — rows wider than the sheet's first row (reported);
* ``grid_to_cells`` — a written positional grid back to cells (Silver's input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEADER_SEP = " / "


def column_names(width: int) -> list[str]:
    """``col_01 … col_NN`` (``col_100`` past 99)."""
    return [f"col_{i:02d}" for i in range(1, width + 1)]


def sheet_width(cells: DataFrame) -> int:
    """Widest row over all sheets (one small aggregate)."""
    return int(cells.agg(F.max("col_idx")).first()[0] or 0)


def to_grid(cells: DataFrame, width: int | None = None, keys: tuple[str, ...] = ("file", "sheet"),
            text: str = "text") -> DataFrame:
    """Padded string grid: ``keys…, row_idx, col_01…col_NN``.

    Rows without any cell survive; missing cells are ``''``.  Cells are packed
    per row into a map (a row holds at most ``width`` cells), then spread into
    columns.
    """
    keys = list(keys)
    width = width if width is not None else sheet_width(cells)
    rows = cells.groupBy(*keys, "row_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", text))).alias("_cells"),
        F.max("col_idx").alias("_max_col"))
    # each packed row also brings the blank rows between its predecessor and
    # itself, so neither a second pass nor one array per sheet is needed
    before = F.lag("row_idx", 1, 0).over(Window.partitionBy(*keys).orderBy("row_idx"))
    rows = rows.withColumn("_from", before + 1)
    rows = rows.withColumn("_at", F.explode(F.sequence(F.col("_from"), F.col("row_idx"))))
    own = F.col("_at") == F.col("row_idx")
    grid = rows.select(*keys, F.col("_at").alias("row_idx"), F.when(own, F.col("_cells")).alias("_cells"),
                       F.when(own, F.col("_max_col")).alias("_max_col"))
    cols = [F.coalesce(F.element_at(F.col("_cells"), F.lit(i)), F.lit("")).alias(name)
            for i, name in enumerate(column_names(width), 1)]
    # a cell beyond the given width fails the job rather than vanishing; the
    # check rides on the first column so it cannot be pruned away
    cols[0] = F.when(F.col("_max_col") > width, F.raise_error(F.concat(
        F.lit(f"cell beyond grid width {width} in row "), F.col("row_idx").cast("string")))
    ).otherwise(F.coalesce(F.element_at(F.col("_cells"), F.lit(1)), F.lit(""))).alias(column_names(width)[0])
    return grid.select(*keys, "row_idx", *cols)


def grid_shape(cells: DataFrame, keys: tuple[str, ...] = ("file", "sheet")) -> DataFrame:
    """Rows, columns and non-empty cells per sheet."""
    return cells.groupBy(*keys).agg(
        F.max("row_idx").alias("n_rows"), F.max("col_idx").alias("n_cols"),
        F.count(F.lit(1)).alias("n_cells"))


def with_header_count(cells: DataFrame, header_rows: DataFrame,
                      keys: tuple[str, ...] = ("file", "sheet")) -> DataFrame:
    """Cells with the number of header rows of their sheet; a sheet that has
    no entry fails the job."""
    joined = cells.join(header_rows.select(*keys, "header_rows"), list(keys), "left")
    missing = F.raise_error(F.concat(F.lit("sheet without header row entry: "),
                                     F.concat_ws("/", *keys))).cast("int")
    return joined.withColumn("header_rows", F.coalesce(F.col("header_rows"), missing))


def with_blank_cells(cells: DataFrame, header_rows: DataFrame, keys: tuple[str, ...] = ("file", "sheet"),
                     text: str = "text") -> DataFrame:
    """Header cells of every position ``1..width`` (absent ones ``''``).

    ``header_rows``: ``keys…, header_rows`` (rows 1..n of a sheet are header).
    Only header-row cells take part.  A sheet without an entry in
    ``header_rows`` fails the job: its cells must not vanish.
    """
    keys = list(keys)
    hr = header_rows.select(*keys, "header_rows")
    cells = with_header_count(cells, header_rows, tuple(keys))
    widths = cells.groupBy(*keys).agg(F.max("col_idx").alias("_w"))
    positions = (widths.join(hr, keys)
                 .select(*keys, F.explode(F.sequence(F.lit(1), F.col("header_rows"))).alias("row_idx"),
                         F.col("_w"))
                 .select(*keys, "row_idx", F.explode(F.sequence(F.lit(1), F.col("_w"))).alias("col_idx")))
    head = (cells.where(F.col("row_idx") <= F.col("header_rows"))
            .select(*keys, "row_idx", "col_idx", text))
    return positions.join(head, [*keys, "row_idx", "col_idx"], "left") \
        .withColumn(text, F.coalesce(F.col(text), F.lit("")))


def fill_headers(header_cells: DataFrame, keys: tuple[str, ...] = ("file", "sheet"),
                 text: str = "text", out: str = "filled") -> DataFrame:
    """Forward-fill blank header cells along their row (merged cells keep
    their value only in the first cell).  The window is one header row, so
    its size is bounded by the sheet width."""
    w = (Window.partitionBy(*keys, "row_idx").orderBy("col_idx")
         .rowsBetween(Window.unboundedPreceding, 0))
    return header_cells.withColumn(out, F.last(F.nullif(F.col(text), F.lit("")), ignorenulls=True).over(w))


def header_names(filled: DataFrame, keys: tuple[str, ...] = ("file", "sheet"),
                 filled_col: str = "filled") -> DataFrame:
    """One name per column: the filled header rows top to bottom, joined
    with ``" / "`` (blank levels skipped)."""
    ordered = F.array_sort(F.collect_list(F.struct("row_idx", filled_col)))
    return filled.groupBy(*keys, "col_idx").agg(
        F.concat_ws(HEADER_SEP, F.transform(ordered, lambda s: s[filled_col])).alias("header"))


def label_cells(cells: DataFrame, header_rows: DataFrame, keys: tuple[str, ...] = ("file", "sheet"),
                text: str = "text") -> DataFrame:
    """Data cells (below the header) with their column's header name.

    The header names are one row per sheet column (at most 16,384 per sheet).
    They are computed once and written as a small table, so the join to the
    data cells is planned from their real size — a broadcast.  A narrow sheet
    puts a large share of all cells on one ``col_idx``, which a shuffle join
    would send to a single task; a row count instead of the write would
    recompute the header pass over the whole cell table.
    """
    from indicata.sinks.files import materialize

    keys = list(keys)
    hdr = materialize(header_names(fill_headers(with_blank_cells(cells, header_rows, tuple(keys), text),
                                                tuple(keys), text), tuple(keys)), "header_names")
    data = with_header_count(cells, header_rows, tuple(keys)) \
        .where(F.col("row_idx") > F.col("header_rows")).drop("header_rows")
    return data.join(hdr, [*keys, "col_idx"], "left")


def wider_than_header(cells: DataFrame, keys: tuple[str, ...] = ("file", "sheet")) -> DataFrame:
    """Rows with cells beyond the last cell of the sheet's first row (the
    loader that sized its frame from row 1 would break on them); the grid
    itself is sized by the widest row, so these are reported, not lost."""
    keys = list(keys)
    widths = cells.groupBy(*keys, "row_idx").agg(F.max("col_idx").alias("n_cols"))
    first = widths.where(F.col("row_idx") == 1).select(*keys, F.col("n_cols").alias("header_cols"))
    return widths.join(first, keys, "left").where(
        F.col("header_cols").isNull() | (F.col("n_cols") > F.col("header_cols")))


def grid_to_cells(grid: DataFrame, keys: tuple[str, ...] = ("file", "sheet"),
                  row_col: str = "row_idx", extra: tuple[str, ...] = ()) -> DataFrame:
    """Positional grid (``col_01…``) back to the long cell table, blanks
    dropped — how Silver reads a written Bronze grid."""
    data = [c for c in grid.columns if c.startswith("col_")]
    long = grid.select(*keys, F.col(row_col).alias("row_idx"), *extra, F.explode(F.array(*[
        F.struct(F.lit(int(c[4:])).alias("col_idx"), F.col(c).alias("text")) for c in data])).alias("c"))
    return long.select(*keys, "row_idx", *extra, "c.col_idx", "c.text").where(F.col("text") != "")
