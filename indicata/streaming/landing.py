"""S10 — land delimited files incrementally with Structured Streaming.

The batch loader reloads everything; for a landing folder that keeps
receiving files, a file stream hands over the names of the new files (the
checkpoint records which), and each micro-batch reads its files with the
batch reader: every file by its own header, whole records of malformed rows
to quarantine.  ``availableNow`` processes what has arrived and stops, so the
job can be scheduled like a batch job; a lost executor or a killed run
resumes from the checkpoint without duplicating files.

The columns of the target may grow: each micro-batch writes the columns of
its own files, and ``read_landing`` lays them over one another.  Which columns
a micro-batch brought or lacked is reported beside the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from indicata.functions.text import file_name
from indicata.sinks.files import read_snapshot
from indicata.sources.csv_text import RECORD_COL, data_columns, overlong_rows, read_delimited_files, well_formed

COLUMNS = "batch bigint, column string, change string"


def known_columns(spark: SparkSession, target: str, before: int) -> list[str]:
    """Columns that the batches before this one wrote, in the order in which they first came."""
    try:
        seen = spark.read.schema(COLUMNS).parquet(f"{target}_columns")
        rows = seen.where((F.col("batch") < before) & (F.col("change") == "new")).collect()
    except Exception as missing:   # the first batch finds no report
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return []
    return [r.column for r in sorted(rows, key=lambda r: r.batch)]


def start_landing(spark: SparkSession, landing: str, target: str, checkpoint: str, sep: str = ";",
                  run_ts_col: str = "_ingestion_timestamp", multiline: bool = False, encoding: str = "UTF-8",
                  max_files: int = 1000) -> StreamingQuery:
    """Start an ``availableNow`` stream from ``landing`` into the Parquet tables
    ``target`` (Bronze), ``target + "_quarantine"`` (whole records of rows with
    more fields than their header or an open quote) and ``target + "_columns"``
    (``batch, column, change``: ``new`` where no batch before had the column,
    ``missing`` where earlier ones had it and this one lacks it).

    The tables are written per micro-batch under its number, so a batch that
    is repeated after a failure overwrites its own files.  ``max_files`` bounds
    the names that one micro-batch brings to the driver."""
    # only names are asked for: the contents are left to the batch reader
    names = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files)
             .schema("path string, modificationTime timestamp, length bigint, content binary")
             .load(landing).where(F.col("length") > 0).select("path"))

    def store(batch: DataFrame, number: int) -> None:
        files = [r.path for r in batch.collect()]
        if not files:
            return
        session = batch.sparkSession
        read = read_delimited_files(session, files, sep, encoding, multiline)
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias(run_ts_col)
        lineage = [stamp, file_name(F.col("_source_path")).alias("_source_file")]
        own = data_columns(read)
        known = known_columns(session, target, number)
        changes = [(number, c, "new") for c in own if c not in known]
        changes += [(number, c, "missing") for c in known if c not in own]
        for part, path in (
                (session.createDataFrame(changes, COLUMNS).coalesce(1).drop("batch"), f"{target}_columns"),
                (well_formed(read).select(*[F.col(f"`{c}`") for c in own], *lineage), target),
                (overlong_rows(read).select(RECORD_COL, *lineage), f"{target}_quarantine")):
            part.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_landing(spark: SparkSession, target: str) -> DataFrame:
    """Everything landed so far: the columns of all batches, ``''`` where the
    files of a batch lacked one."""
    found = read_snapshot(spark, target).drop("batch")
    return found.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in found.columns])
