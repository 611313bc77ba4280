"""Access to the landed input tables (one Parquet dataset per table).

Reads are lazy: Catalyst prunes columns and pushes filters into the scan of
whatever a query actually uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


class Tables:
    """``Tables(spark, dir).orders`` -> DataFrame of ``dir/orders.parquet``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        # one reader per table (file listing and schema resolved once)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]
