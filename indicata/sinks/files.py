"""File sinks.

Every write is idempotent: a snapshot overwrites its location, and a per-file
output overwrites only the partitions (files) it carries (dynamic partition
overwrite).  Tables that are read while they change are in ``sinks/versions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from indicata.session import scratch_path


def write_snapshot(df: DataFrame, path: str, per_file_col: str | None = None) -> str:
    """Overwrite a Parquet snapshot (no index column).

    ``per_file_col``: one output directory per value of that column (one per
    input file); only directories present in ``df`` are replaced.
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if per_file_col:
        w = w.partitionBy(per_file_col)
    w.parquet(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A written snapshot with the columns of all its files (outputs of
    different runs may be of different width)."""
    return spark.read.option("mergeSchema", True).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a reader over it.

    Used where one intermediate result feeds several consumers (a Silver
    table feeding every Gold dimension and the fact): the lineage is cut, the
    work is done once, and the readers get column pruning and file statistics
    (which the planner uses for its own broadcast size check).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_all(frames: dict[str, DataFrame], max_parallel: int = 8) -> dict[str, DataFrame]:
    """``materialize`` several independent frames, submitting their write
    jobs concurrently (Spark schedules jobs from different threads side by
    side), so many small tables cost about one job's latency."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(frames)))) as pool:
        futures = {name: pool.submit(materialize, df, name) for name, df in frames.items()}
        return {name: f.result() for name, f in futures.items()}
