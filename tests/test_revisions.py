"""M2: re-pulled histories are merged, not added up; measures that don't add up are averaged."""

import pytest
from pyspark.sql import functions as F

from indicata.operators.silver import history, roll_up, superseded
from indicata.plans.run import RunConfig, energy_documents, run_medallion


def payload(*points):
    values = ",".join(f'{{"datetime":"{t}-01","value":{v},"percentage":{p}}}' for t, v, p in points)
    return '{"included":[{"type":"d","attributes":{"values":[' + values + "]}}]}"


LANDED = "geo_name string, year int, body string, loaded_at timestamp"


def land(spark, path, rows):
    spark.createDataFrame([(*x[:3], None) for x in rows], LANDED).withColumn("loaded_at", F.element_at(
        F.create_map(*[F.lit(y) for x in rows for y in (x[2] + x[0], x[3])]), F.concat("body", "geo_name")).cast(
        "timestamp")).write.mode("append").parquet(path)


def test_a_revised_repull_replaces_what_it_answers_again(spark, tmp_path):
    landed = str(tmp_path / "energy")
    land(spark, landed, [("Madrid", 2024, payload(("2024-01", 100, 0.5), ("2024-02", 7, 0.5)), "2024-03-01"),
                         ("Cat", 2024, payload(("2024-01", 1, 0.25)), "2024-03-01")])
    land(spark, landed, [("Madrid", 2024, payload(("2024-01", 110, 0.5), ("2024-01", 5, 0.75)), "2024-04-01")])
    land(spark, landed, [("Cat", 2024, payload(("2024-01", 1, 0.25)), "2024-05-01")])    # repeated, not revised
    conf = RunConfig(lake=str(tmp_path / "lake"), log=str(tmp_path / "log"), energy_payloads=landed)
    out = run_medallion(spark, conf)
    got = {(r.region, r.measure, r.period.month): float(r.value) for r in out["monthly"].collect()}
    assert got == {("Madrid", "value", 1): 115, ("Madrid", "value", 2): 7, ("Cat", "value", 1): 1,
                   ("Madrid", "percentage", 1): 0.625, ("Madrid", "percentage", 2): 0.5, ("Cat", "percentage", 1): 0.25}
    counted = {r.layer: r.rows for r in out["accounting"].where("source = 'energy'").collect()}
    assert (counted["landed"], counted["silver_ok"], counted["silver_superseded"]) == (10, 8, 2)
    old = [(r.region, r.measure, r.raw_values, str(r.valid_from)[:10], str(r.valid_to)[:10])
           for r in out["history_energy"].orderBy("measure").collect()]
    assert old == [("Madrid", "percentage", ["0.5"], "2024-03-01", "2024-04-01"),
                   ("Madrid", "value", ["100"], "2024-03-01", "2024-04-01")]
    assert spark.read.parquet(str(tmp_path / "lake" / "quality" / "duplicates")).collect()[0].copies == 2
    # the same landing again gives the same tables
    again = {(r.region, r.measure, r.period.month): float(r.value) for r in run_medallion(spark, conf)["monthly"].collect()}
    assert again == got


def test_two_answers_at_one_time_fail(spark):
    rows = spark.createDataFrame([("Madrid", 2024, "a"), ("Madrid", 2024, "b")], "geo_name string, year int, body string")
    with pytest.raises(Exception, match="two answers to one request"):
        energy_documents(rows.withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp")), ["geo_name", "year"])


def test_a_body_that_comes_back_is_a_version(spark):
    rows = spark.createDataFrame([("M", b, t) for t, b in enumerate("aabba")], "geo_name string, body string, t int")
    rows = rows.withColumn("loaded_at", F.timestamp_seconds("t")).drop("t")
    got = energy_documents(rows, ["geo_name"]).orderBy("loaded_at").collect()
    assert [(r.body, r.copies) for r in got] == [("a", 2), ("b", 2), ("a", 1)]


def test_history_and_superseded_in_one_shuffle_each(spark):
    rows = spark.createDataFrame([("k", 1, "x"), ("k", 2, "x"), ("k", 3, "y"), ("k", 4, "x"), ("k", 4, "z"),
                                  ("other", 1, None), (None, 1, "n"), (None, 2, "m")], "key string, load int, v string")
    old = history(rows, ["key"], "load", ["v"])
    assert sorted((str(r.key), [x.v for x in r.versions], r.valid_from, r.valid_to) for r in old.collect()) == [
        ("None", ["n"], 1, 2), ("k", ["x"], 1, 3), ("k", ["y"], 3, 4)]
    seen = rows.withColumn("old", superseded(rows, ["key"], "load"))
    assert {(r.key, r.load): r.old for r in seen.collect()} == {
        ("k", 1): True, ("k", 2): True, ("k", 3): True, ("k", 4): False, ("other", 1): False, (None, 1): True,
        (None, 2): False}
    for df in (old, seen):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("Exchange hashpartitioning") == 1, plan


def test_roll_up_by_the_flag(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("m", "1"), ("m", "0.0001"), ("m", None)], "k string, v string")
    rows = rows.withColumn("value", F.col("v").cast("decimal(18,4)"))
    got = {r.k: str(r.value) for r in roll_up(rows, ["k"], F.col("k") == "a").collect()}
    assert got == {"a": "3.0000", "m": "0.5001"}
    with pytest.raises(Exception, match="without additive flag"):
        roll_up(rows, ["k"], F.when(F.col("k") == "a", True)).collect()
