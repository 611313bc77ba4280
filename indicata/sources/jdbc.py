"""S9/K2 — staging tables over JDBC.

Full reload: the table is replaced, every column created as a bounded text
type (``VARCHAR(500)`` by default; ``NVARCHAR`` where the database has it), ``''`` stored as NULL, rows inserted in
batches of 5,000.  Each task writes its partition in its own transaction, so
partitions load in parallel; a failure leaves the committed partitions, as
the batch-committed loader did.  Values wider than the column are reported
*before* the load (``width_violations``) rather than discovered by the
database.

Reads split the table on a numeric column into ``num_partitions`` ranges.
Counts and samples are taken by the database, not carried over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.text import empty_to_null

STAGING_WIDTH = 500
BATCH_SIZE = 5_000


def staging_ddl(columns: list[str], width: int = STAGING_WIDTH, text_type: str = "VARCHAR") -> str:
    """``createTableColumnTypes`` value: every column a bounded text type."""
    return ", ".join(f"`{c}` {text_type}({width})" for c in columns)


def write_staging(df: DataFrame, url: str, table: str, properties: dict | None = None,
                  width: int = STAGING_WIDTH, batch_size: int = BATCH_SIZE,
                  empty_as_null: bool = True, text_type: str = "VARCHAR") -> None:
    """Drop-and-create ``table`` and load ``df`` (all strings, ``''`` -> NULL)."""
    text = [F.col(f"`{c}`").cast("string") for c in df.columns]
    staged = df.select(*[(empty_to_null(t) if empty_as_null else t).alias(c) for t, c in zip(text, df.columns)])
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    (staged.write.mode("overwrite")
     .option("createTableColumnTypes", staging_ddl(df.columns, width, text_type))
     .option("truncate", "false")
     .jdbc(url, table, properties=props))


def _query(spark: SparkSession, url: str, query: str, properties: dict | None) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**(properties or {})).load()


def table_count(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> int:
    """Rows of a table, counted by the database."""
    return int(_query(spark, url, f"SELECT COUNT(*) AS n FROM {table}", properties).first()[0])


def table_sample(spark: SparkSession, url: str, table: str, order_cols: list[str], n: int = 5,
                 properties: dict | None = None) -> DataFrame:
    """The first ``n`` rows in the order of ``order_cols`` (quoted names), cut by the database."""
    order = ", ".join('"' + c.replace('"', '""') + '"' for c in order_cols)
    return _query(spark, url, f"SELECT * FROM {table} ORDER BY {order} OFFSET 0 ROWS FETCH NEXT {n} ROWS ONLY",
                  properties)


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    """Parallel JDBC read; ranges of ``partition_column`` when given."""
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=props)
