import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.operators.joins import upsert
from indicata.operators.quality import (column_profile, count_check, log_audit, progress,
                                        reconcile_diff, reconcile_exact, sample_rows, totals_vs_expected)
from indicata.operators.silver import (apply_scope, cleanse_text, consolidate, dedup_exact, dedup_latest,
                                       enforce_types, map_values, reject_rows, typed_rows, unmapped,
                                       unpivot_measures, verify_types)
from indicata.plans.silver import month_from_text, reject_rows as energy_rejects, silver_energy, tidy_rows


def test_enforce_types_and_rejects(spark):
    df = spark.createDataFrame([("1", "1.234,5", "2024-01-31"), ("2", "n/a", "31/01/2024"), ("3", "", None)],
                               "id string, v string, d string")
    e = enforce_types(df, {"v": "decimal(18,4)", "d": "date"}, decimal_comma=True)
    typed = {r.id: r for r in typed_rows(e).collect()}
    assert str(typed["1"].v) == "1234.5000" and typed["1"].d == dt.date(2024, 1, 31)
    rej = sorted((r.id, r.column, r.raw) for r in reject_rows(e, ["id"]).collect())
    assert rej == [("2", "d", "31/01/2024"), ("2", "v", "n/a")]      # '' and NULL are blanks, not rejects


def test_cleanse_and_month_parsing(spark):
    df = spark.createDataFrame([("  a   b ",), (" N/A ",), ("",), ("..",)], "s string")
    assert [r.c for r in df.select(cleanse_text("s").alias("c")).collect()] == ["a b", None, None, None]
    m = spark.createDataFrame([("2014-01-01T00:00:00.000+01:00",), ("2024M03",)], "t string")
    assert [r.p for r in m.select(month_from_text(F.col("t")).alias("p")).collect()] == [
        dt.date(2014, 1, 1), dt.date(2024, 3, 1)]                    # offset never moves the month


def test_verify_types(spark):
    df = spark.createDataFrame([(1, "12,5"), (2, None), (3, "7")], "a bigint, b string")
    contract = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DecimalType(18, 2)),
                             T.StructField("c", T.StringType())])
    got = {r.column_name: r for r in verify_types(df, contract).collect()}
    assert got["a"].type_ok and got["b"].actual_type == "string" and not got["b"].type_ok
    assert (got["b"].null_count, got["b"].cast_failures) == (1, 1)
    assert got["c"].actual_type is None


def test_scope_pushdown(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = apply_scope(o, "o_orderdate", "since=1999-01")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert apply_scope(o, "o_orderdate", "full_history") is o


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 5.0)], "k int, a double, b double")
    long = unpivot_measures(df, ["k"], ["a", "b"], value_type="double")
    assert long.count() == 4                                       # blanks kept
    back = long.groupBy("k").pivot("measure", ["a", "b"]).agg(F.first("value"))
    assert sorted(back.collect()) == sorted(df.collect())


def test_consolidate_and_dedup(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    c = consolidate([a, b])
    assert sorted(c.columns) == ["a", "b", "k"] and c.count() == 2
    d = spark.createDataFrame([(1, dt.date(2024, 1, 1), "old"), (1, dt.date(2024, 2, 1), "a"),
                               (1, dt.date(2024, 2, 1), "b"), (2, dt.date(2024, 1, 1), "z"), (2, dt.date(2024, 1, 1), "z")],
                              "k int, ts date, v string")
    assert sorted((r.k, r.v) for r in dedup_latest(d, ["k"], ["ts"]).collect()) == [(1, "b"), (2, "z")]
    assert dedup_exact(d).count() == 4


def test_mapping_and_unmapped(spark):
    df = spark.createDataFrame([("Madrid",), ("Atlantis",), ("Atlantis",)], "delegation string")
    m = spark.createDataFrame([("Madrid", "Comunidad de Madrid")], "delegation string, region string")
    assert map_values(df, m, "delegation", "region").where("region is null").count() == 2
    assert [(r.delegation, r.n_rows) for r in unmapped(df, m, "delegation").collect()] == [("Atlantis", 2)]


def test_reconcile_and_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    cur = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k int, v string")
    assert reconcile_diff(base, base, ["k"]).count() == 0              # diff(x, x) is empty
    assert sorted((r.k, r.change) for r in reconcile_diff(base, cur, ["k"]).collect()) == [
        (2, "removed"), (3, "changed"), (4, "added")]
    assert reconcile_exact(base, base).count() == 0
    assert count_check(base, cur).first().status == "OK"
    assert count_check(base, cur.limit(1)).first().status == "MISMATCH"
    upd = spark.createDataFrame([(2, "B"), (9, "new")], "k int, v string")
    once = upsert(base, upd, ["k"])
    twice = upsert(once, upd, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())           # idempotent
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "B"), (3, None), (9, "new")]


def test_run_log_audit(spark):
    t = dt.datetime
    log = spark.createDataFrame([
        ("r1", "bronze", "start", t(2024, 1, 1, 0, 0)), ("r1", "bronze", "success", t(2024, 1, 1, 0, 5)),
        ("r2", "bronze", "start", t(2024, 1, 2, 0, 0)), ("r2", "bronze", "failure", t(2024, 1, 2, 0, 1)),
        ("r3", "bronze", "start", t(2024, 1, 3, 0, 0))], "run_id string, step string, event string, ts timestamp")
    got = {r.run_id: (r.last_state, r.duration_us, r.n_events) for r in log_audit(log, "run_id", "ts", "event").collect()}
    assert got == {"r1": ("success", 300_000_000, 2), "r2": ("failure", 60_000_000, 2), "r3": ("start", 0, 1)}


def test_profile_progress_totals_sample(spark):
    df = spark.createDataFrame([(1, ""), (2, "x"), (3, None)], "k int, s string")
    prof = {r.column_name: r for r in column_profile(df).collect()}
    assert (prof["s"].n_rows, prof["s"].n_non_null, prof["s"].n_empty, prof["s"].n_distinct) == (3, 2, 1, 2)
    approx = {r.column_name: r for r in column_profile(df, exact=False).collect()}
    assert (approx["s"].n_rows, approx["s"].n_non_null, approx["s"].n_empty, approx["s"].n_distinct) == (3, 2, 1, 2)
    p = progress(df.withColumn("g", F.lit("a")), ["g", "k"], [F.col("g"), F.col("k")]).orderBy("k").collect()
    assert [r.running_rows for r in p] == [1, 2, 3]
    tv = totals_vs_expected(spark.createDataFrame([("a", 1)], "g string, n int"),
                            spark.createDataFrame([("a", 2)], "g string, n int"), ["g"], ["n"]).first()
    assert tv.status == "MISMATCH"
    assert [r.k for r in sample_rows(df, ["k"], 2).collect()] == [1, 2]


def test_silver_energy_contract(spark):
    b = spark.createDataFrame([("Demanda", "Madrid", "2014-01-01T00:00:00.000+01:00", "22733442.07", "1", "ts"),
                               ("Demanda", "Madrid", "2014-02-01T00:00:00.000+01:00", "abc", None, "ts")],
                              "series_type string, geo_name string, datetime string, value string, "
                              "percentage string, _ingestion_timestamp string")
    seen = silver_energy(b)
    tidy, rejects = tidy_rows(seen), energy_rejects(seen)
    assert seen.count() == 4 and seen.where("status = 'blank'").count() == 1
    assert tidy.columns == ["source", "indicator", "region", "period", "measure", "value"]
    assert tidy.schema["value"].dataType.simpleString() == "decimal(18,4)"
    assert sorted((str(r.period), r.measure, str(r.value)) for r in tidy.collect()) == [
        ("2014-01-01", "percentage", "1.0000"), ("2014-01-01", "value", "22733442.0700")]
    assert [r.raw for r in rejects.collect()] == ["abc"]


def test_number_grammar_and_periods(spark):
    from indicata.operators.silver import parse_as

    rows = [("1.234,5", "1234.5000"), ("1234,5", "1234.5000"), ("1234.56", None), ("1.23.4", None), ("12.345.678", "12345678.0000"),
            ("-0,5", "-0.5000"), ("1,2,3", None), ("7", "7.0000")]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = {r.t: r.v and str(r.v) for r in df.select("t", parse_as(F.col("t"), "decimal(18,4)", True).alias("v")).collect()}
    assert got == dict(rows)
    months = spark.createDataFrame([("2024M13",), ("n/d",), (None,), ("2024M12",)], "t string")
    assert [r.m and r.m.isoformat() for r in months.select(month_from_text(F.col("t")).alias("m")).collect()] == [
        None, None, None, "2024-12-01"]


def test_null_keys(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, v int")
    assert reconcile_diff(a, a, ["k"]).count() == 0
    totals = totals_vs_expected(a, a, ["k"], ["v"]).collect()
    assert sorted((r.k or 0, r.status) for r in totals) == [(0, "OK"), (1, "OK")]
    new = spark.createDataFrame([(None, 9), (3, 3)], "k int, v int")
    assert sorted((r.k or 0, r.v) for r in upsert(a, new, ["k"]).collect()) == [(0, 9), (1, 2), (3, 3)]


def test_upsert_of_one_key_twice_fails(spark):
    import pytest

    a = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(Exception, match="several updates of one key"):
        upsert(a, a.union(a), ["k"]).collect()


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    got = sorted((r.column_name, r.n_rows, r.n_distinct) for r in column_profile(df).collect())
    assert got == [("a", 0, 0), ("b", 0, 0)]


def test_scope_values(spark, sf_small):
    import pytest

    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    assert apply_scope(o, "o_orderdate", "since=1999-01-15").where("o_orderdate < '1999-01-15'").count() == 0
    with pytest.raises(ValueError):
        apply_scope(o, "o_orderdate", "last_month")
