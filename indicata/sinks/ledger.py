"""M4 — what a run's steps were made from, so that unchanged ones are skipped and new files alone are loaded.

One row per finished step: its fingerprint (configuration and input), the
files that it read (name, size, time of change) and what later steps need of
it.  A row is added only after the step's output is complete: a run that was
killed finds the last whole state.
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from indicata.sinks.files import materialize

STEPS = "step string, number bigint, at double, fingerprint string, files string, state string"
FILES = "path string, length bigint, changed timestamp"


def fingerprint(*parts) -> str:
    """A hash of configuration values (anything JSON can say)."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def listing(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``path, length, changed`` of the files under a landing; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("changed"))


def digest(files: DataFrame) -> str:
    """One value for a set of files, whatever their order; one row reaches the driver."""
    each = F.xxhash64("path", "length", "changed").cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.sum(each)).first()
    return f"{n}:{total}"


@dataclass
class Step:
    number: int          # counts the times that the step was done
    fingerprint: str
    files: str | None    # where its file list is
    state: dict


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def last(self, step: str) -> Step | None:
        """The step as it was last finished."""
        try:
            rows = self.spark.read.schema(STEPS).parquet(f"{self.root}/steps").where(F.col("step") == step)
            row = rows.orderBy(F.desc("number")).first()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return None
        return Step(row.number, row.fingerprint, row.files, json.loads(row.state)) if row else None

    def done(self, step: str, number: int, mark: str, state: dict, files: DataFrame | None = None) -> Step:
        """Enter a finished step (its files first)."""
        path = None
        if files is not None:
            path = f"{self.root}/files/{step}-{number}-{mark[:12]}"
            files.write.mode("overwrite").parquet(path)
        row = (step, number, time.time(), mark, path, json.dumps(state, default=str))
        self.spark.createDataFrame([row], STEPS).coalesce(1).write.mode("append").parquet(f"{self.root}/steps")
        return Step(number, mark, path, state)

    def added(self, now: DataFrame, last: Step | None) -> list[str] | None:
        """Names of the files that came since; None if there was no such step, or files changed or went away, so that
        everything has to be loaded again.  The comparison is a join; the new names reach the driver, as for any read."""
        if last is None or last.files is None:
            return None
        before = self.spark.read.schema(FILES).parquet(last.files)
        both = materialize(now.withColumn("_now", F.lit(True)).join(
            before.withColumn("_before", F.lit(True)), ["path", "length", "changed"], "full"), "ledger_files")
        if both.where("_now IS NULL").limit(1).count():
            return None
        return [r.path for r in both.where("_before IS NULL").select("path").collect()]
