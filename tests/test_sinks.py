import pytest
from pyspark.sql import functions as F

from indicata.operators.joins import upsert
from indicata.sinks.files import read_snapshot, write_snapshot


def test_per_file_snapshot_replaces_only_touched_files(spark, tmp_path):
    path = str(tmp_path / "snap")
    first = spark.createDataFrame([("a.xls", 1), ("a.xls", 2), ("b.xls", 3)], "_source_file string, v int")
    write_snapshot(first, path, per_file_col="_source_file")
    again = spark.createDataFrame([("a.xls", 10)], "_source_file string, v int")
    write_snapshot(again, path, per_file_col="_source_file")          # reload of a.xls only
    got = sorted((r._source_file, r.v) for r in read_snapshot(spark, path).collect())
    assert got == [("a.xls", 10), ("b.xls", 3)]
    write_snapshot(first.where("v < 3"), path)                         # plain snapshot: full overwrite
    assert read_snapshot(spark, path).count() == 2


def test_step_logger_records_failure_and_success(spark, tmp_path):
    from indicata.operators.quality import log_audit
    from indicata.sinks.run_log import StepLogger, read_log

    log = StepLogger(spark, str(tmp_path / "log"), run_id="r1")
    with log.step("ok_step") as info:
        info["rows_out"] = 5
    with pytest.raises(ValueError), log.step("bad_step"):
        raise ValueError("landing missing")
    rows = {(r.step, r.event): r for r in read_log(spark, str(tmp_path / "log")).collect()}
    assert rows[("ok_step", "success")].rows_out == 5
    assert "landing missing" in rows[("bad_step", "failure")].message
    audit = log_audit(read_log(spark, str(tmp_path / "log")).where("step = 'bad_step'"), "run_id", "ts", "event")
    assert audit.first().last_state == "failure"
