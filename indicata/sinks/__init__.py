"""Sinks: Parquet snapshots and lake tables, run log, JDBC full reload."""
