"""indicata — a PySpark medallion engine for economic-indicator data.

Bronze (all-string landings with lineage) -> Silver (typed, tidy, deduplicated)
-> Gold (star schema and derived measures), with reconciliation checks and a
run log.  Every operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions; Python runs only inside the workbook decode.

Entry points: ``indicata.session.configure`` / ``local_session``,
``indicata.plans.run.run_medallion`` (one call, landing to Gold) and the
layer modules under ``indicata.sources``, ``indicata.operators``,
``indicata.plans``, ``indicata.sinks`` and ``indicata.streaming``.
"""

__version__ = "0.1.0"

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming", "session", "tables"]
