"""S6 — file manifest: per-file constants attached to every row of a file.

A file with no manifest row is an error (raised on the executors, no driver
round trip).  The manifest is small by nature (one row per landed file) and is
left to the planner's broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_with_manifest(df: DataFrame, manifest: DataFrame, file_col: str,
                      manifest_key: str = "file_id", strict: bool = True) -> DataFrame:
    """Left join rows to their manifest entry on the file name."""
    m = manifest.withColumn("_known", F.lit(True))
    j = df.join(m, df[file_col] == m[manifest_key], "left")
    if strict:
        j = j.withColumn("_known", F.when(
            F.col("_known").isNull(),
            F.raise_error(F.concat(F.lit("file without manifest row: "), F.col(file_col).cast("string")))
        ).otherwise(F.col("_known")))
        j = j.where(F.col("_known"))
    return j.drop("_known", manifest_key) if manifest_key != file_col else j.drop("_known")
