"""K5 — run log: one row per step event, appended.

``run_id, step, event (start|success|failure), ts, rows_in, rows_out, message``.
Row counts come from ``Observation`` metrics collected by the write itself,
so counting never costs a second pass over the data.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("run_id string, step string, event string, ts timestamp, rows_in bigint, "
              "rows_out bigint, message string")


def new_run_id() -> str:
    return uuid.uuid4().hex


def append_events(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, LOG_SCHEMA).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def observed(df: DataFrame, name: str, metrics: dict | None = None) -> tuple[DataFrame, Observation]:
    """Attach a row counter (``rows``) and more aggregates (name -> column)
    that are filled when ``df`` is written."""
    obs = Observation(name)
    more = [v.alias(k) for k, v in (metrics or {}).items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *more), obs


class StepLogger:
    """Write start/success/failure rows around each step of a run."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark, self.path = spark, path
        self.run_id = run_id or new_run_id()

    def _now(self):
        return datetime.now(timezone.utc).replace(tzinfo=None)

    def event(self, step: str, event: str, rows_in=None, rows_out=None, message=None):
        append_events(self.spark, self.path,
                      [(self.run_id, step, event, self._now(), rows_in, rows_out, message)])

    @contextmanager
    def step(self, name: str):
        """``with log.step('bronze_ipi') as s: ... s['rows_out'] = n``."""
        info: dict = {}
        self.event(name, "start")
        try:
            yield info
        except Exception as exc:
            self.event(name, "failure", info.get("rows_in"), info.get("rows_out"),
                       f"{type(exc).__name__}: {exc}")
            raise
        self.event(name, "success", info.get("rows_in"), info.get("rows_out"))
