import math
import random

from pyspark.sql import functions as F

from indicata.functions import (backoff_seconds, cell_text_legacy, cell_text_xlsx, empty_to_null,
                                file_name, file_stem, float_text, iso_utc, json_number_text,
                                null_to_empty, safe_rate, status_class, url_last_segment,
                                url_template)


def test_float_text_matches_python_below_1e16(spark):
    random.seed(7)
    vals = [0.0, -0.0, 0.1, 123.0, -2.5, 1e-4, 9.99e-5, 1e-5, 1.5e-5, 22733442.07, 1e7,
            9999999999999998.0, 1e16, 1.234e20, 5e-324, 1.7976931348623157e308]
    vals += [round(random.uniform(-1e6, 1e6), 2) for _ in range(3000)]
    vals += [random.uniform(0, 1) * 10 ** random.randint(-8, 15) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = df.select("d", float_text("d").alias("t")).collect()
    bad = [(r.d, r.t) for r in got if r.t != repr(r.d)]
    assert bad == []


def test_float_text_special_values(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "d double")
    assert [r.t for r in df.select(float_text("d").alias("t")).collect()] == ["nan", "inf", "-inf", None]


def test_json_number_text_per_value(spark):
    import json

    tokens = ["5", "-0012", "1.50e3", "6.55", "1e7", None, "0", "-0", "-0.0", "1E400", "123456789012345678901234567890"]
    df = spark.createDataFrame([(t,) for t in tokens], "r string")
    got = [r.x for r in df.select(json_number_text("r").alias("x")).collect()]
    valid = [t for t in tokens if t is not None and t != "-0012"]
    python_text = {t: str(json.loads(t)) for t in valid}     # what the loader printed
    assert got == [python_text.get(t, None) if t != "-0012" else "-12" for t in tokens]


def test_cell_text_rules(spark):
    rows = [("5", "n"), ("5.0", "n"), ("5.5", "n"), ("1", "b"), ("0", "b"), ("45321.5", "d"),
            ("45321", "d"), ("#DIV/0!", "e"), (None, "n"), ("x", "s"), ("1E-05", "n")]
    df = spark.createDataFrame(rows, "v string, t string")
    got = df.select(cell_text_xlsx("v", "t").alias("x"), cell_text_legacy("v", "t").alias("y")).collect()
    assert [r.x for r in got] == ["5", "5.0", "5.5", "True", "False", "2024-01-30 12:00:00",
                                  "2024-01-30 00:00:00", "#DIV/0!", "", "x", "1e-05"]
    assert [r.y for r in got] == ["5", "5", "5.5", "1", "0", "45321.5", "45321", "#DIV/0!", "", "x", "1e-05"]


def test_iso_utc_like_isoformat(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05' a, timestamp'2024-01-02 03:04:05.5' b")
    r = df.select(iso_utc("a").alias("a"), iso_utc("b").alias("b")).first()
    assert (r.a, r.b) == ("2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.500000+00:00")


def test_paths_urls_and_nulls(spark):
    df = spark.createDataFrame([("/in/01401400.XLS", "https://h.example/a/b/825?x=1#f", "")], "p string, u string, e string")
    r = df.select(file_name("p").alias("n"), file_stem("p").alias("s"), url_last_segment("u").alias("l"),
                  empty_to_null("e").alias("z"), null_to_empty(F.lit(None).cast("string")).alias("o"),
                  url_template("https://api.example/x", year=F.lit(2014), geo="ccaa").alias("t")).first()
    assert (r.n, r.s, r.l, r.z, r.o) == ("01401400.XLS", "01401400", "825", None, "")
    assert r.t == "https://api.example/x?year=2014&geo=ccaa"


def test_status_backoff_rate(spark):
    df = spark.createDataFrame([(200,), (204,), (429,), (503,), (404,), (None,)], "s int")
    got = [r.c for r in df.select(status_class("s").alias("c")).collect()]
    assert got == ["success", "success", "transient", "transient", "permanent", "transient"]
    r = spark.range(1).select(backoff_seconds(F.lit(3)).alias("b"), safe_rate(F.lit(1), F.lit(0)).alias("z"),
                              safe_rate(F.lit(1), F.lit(3)).alias("q")).first()
    assert r.b == 8 and r.z is None and math.isclose(r.q, 0.333333)


def test_xlsx_date_systems(spark):
    rows = [("1", "d"), ("59", "d"), ("61", "d"), ("0", "d1904"), ("45321.25", "d1904")]
    df = spark.createDataFrame(rows, "v string, t string")
    got = [r.x for r in df.select(cell_text_xlsx("v", "t").alias("x")).collect()]
    assert got == ["1900-01-01 00:00:00", "1900-02-28 00:00:00", "1900-03-01 00:00:00",
                   "1904-01-01 00:00:00", "2028-01-31 06:00:00"]
