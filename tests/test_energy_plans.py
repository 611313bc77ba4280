"""Points don't carry their series along, versions are gathered by one exchange, number texts are Python's."""

import random
import re

from pyspark.sql import functions as F

from indicata.functions.text import json_number_text
from indicata.operators.silver import history
from indicata.sources.json_docs import parse_documents


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_points_go_without_their_series(spark):
    body = '{"included": [{"type": "t", "attributes": {"values": [{"datetime": "d", "value": 1, "percentage": 2}]}}]}'
    found = parse_documents(spark.createDataFrame([("g", body)], "geo_name string, body string"), context=["geo_name"])
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    carried = re.findall(r"Generate explode\([^)]*\), \[([^\]]*)\]", plan)
    assert [re.sub(r"#\d+", "", x) for x in carried] == ["geo_name, series_type", "geo_name"]


def test_history_with_a_constant_key_is_one_exchange(spark):
    r = random.Random(3)
    rows = [(r.choice([None, "a", "b", "c"]), r.randint(0, 9), r.choice([None, 1, 2, 3, 4]), r.choice([None, "x", "y"]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, load int, v string").withColumn("source", F.lit("energy"))
    found = history(df, ["source", "k", "n"], "load", ["v"])
    assert final_plan(found).count("Exchange hashpartitioning") == 1
    want = []
    for key in {x[:2] for x in rows}:
        versions = []   # (load, values), each as it changes
        for load in sorted({x[2] for x in rows if x[:2] == key}, key=lambda x: (x is not None, x)):
            own = sorted((x[3] for x in rows if x[:2] == key and x[2] == load), key=lambda x: (x is not None, x or ""))
            if not versions or versions[-1][0] is None or versions[-1][1] != own:
                versions.append((load, own))
        want += [(*key, own, a, b) for (a, own), (b, _) in zip(versions, versions[1:])]
    got = [(x.k, x.n, [v.v for v in x.versions], x.valid_from, x.valid_to) for x in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_number_texts_as_written(spark):
    r = random.Random(5)
    texts = ["0.0", "-0.0", "1.0", "0.0001", "0.00012", "0.00001", "1.50", "01.5", "12345678901.2345", "9.9999",
             "123456789012.5", "-7.25", "100.10", "0.1000"]
    texts += [f"{r.choice(['', '-'])}{r.randint(0, 10 ** r.randint(1, 12))}.{r.randint(0, 10 ** r.randint(1, 6))}"
              for _ in range(3000)]
    got = spark.createDataFrame([(x,) for x in texts], "x string").select("x", json_number_text("x").alias("y")).collect()
    assert [(x.x, x.y) for x in got if x.y != repr(float(x.x))] == []
