"""Bronze projections: lineage, all-strings, staging NULLs, positional
names, context tags and the width check."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions.text import empty_to_null, file_name, float_text, null_to_empty


def run_stamp(now: datetime | None = None) -> str:
    """One ingestion stamp per run: UTC, ISO 8601 with ``+00:00``."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).isoformat()


def add_lineage(df: DataFrame, run_ts: str, source: str | Column | None = None,
                source_col: str = "_source_file") -> DataFrame:
    """``_ingestion_timestamp`` (same stamp on every row) and the source:
    a literal (API path) or, by default, the name of the file each row came
    from (``_metadata.file_name`` of a file scan)."""
    src = (source if isinstance(source, Column) else F.lit(source)) if source is not None \
        else F.col("_metadata.file_name")
    return df.select("*", F.lit(run_ts).alias("_ingestion_timestamp"), src.alias(source_col))


def as_text(c: str, dtype: T.DataType) -> Column:
    """Bronze text of one value, as the Python loaders printed it: floats by
    ``float_text``, timestamps ``YYYY-MM-DD HH:MM:SS[.ffffff]``, the rest cast."""
    col = F.col(f"`{c}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float_text(col)
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    return col.cast("string")


def all_strings(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column to text (columns in ``keep`` keep their type).  NULL
    stays NULL."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in keep else as_text(f.name, f.dataType).alias(f.name)
                       for f in df.schema.fields])






def width_violations(df: DataFrame, key_cols: list[str], width: int = 500,
                     columns: list[str] | None = None) -> DataFrame:
    """``key…, column_name, n_chars`` for every text longer than ``width``
    characters (what a bounded text column would reject)."""
    cols = columns or [f.name for f in df.schema.fields
                       if isinstance(f.dataType, T.StringType) and f.name not in key_cols]
    items = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.char_length(F.col(f"`{c}`")).alias("n_chars")) for c in cols])
    return (df.select(*key_cols, F.explode(F.filter(items, lambda x: x["n_chars"] > width)).alias("v"))
            .select(*key_cols, "v.column_name", F.col("v.n_chars").cast("bigint").alias("n_chars")))


__all__ = ["run_stamp", "add_lineage", "all_strings", "width_violations", "file_name"]
