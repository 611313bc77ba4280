"""J2 names under spelling variants, J4 by hash tree, J6 on a written fact."""

import pytest
from pyspark.sql import functions as F

from indicata.functions import fold_name
from indicata.operators.quality import _hashes, _unequal_buckets, reconcile_diff, reconcile_tree
from indicata.operators.silver import map_values, name_conflicts, unmapped
from indicata.plans.catalog_gold import written_star
from indicata.plans.gold import star_by_region_month


def test_names_fold(spark):
    cases = {"A Coruña": "coruna", "CORUN\u0303A (A)": "coruna", "Coruña, A": "coruna", "Palmas, Las": "palmas",
             "L'Hospitalet  de Llobregat": "hospitalet de llobregat", "Straße": "strasse", "Ærø": "aero", "Łódź": "lodz",
             "La": "la", "": "", "  ": "", "東京 (都)": "東京 都", "Área 51": "area 51", None: None}
    df = spark.createDataFrame([(x,) for x in cases], "n string").select("n", fold_name("n").alias("f"))
    assert {r.n: r.f for r in df.collect()} == cases


def test_lookups_by_folded_name(spark):
    rows = spark.createDataFrame([(1, "a coruña"), (2, "MALAGA"), (3, "Atlantis"), (4, None)], "i int, d string")
    lookup = spark.createDataFrame([("Coruña (A)", "Galicia"), ("A Coruna", "Galicia"), ("Málaga", "Andalucía"),
                                    (None, "Nowhere")], "d string, region string")
    got = {r.i: r.region for r in map_values(rows, lookup, "d", "region", fold_name).collect()}
    assert got == {1: "Galicia", 2: "Andalucía", 3: None, 4: None}
    assert {r.d for r in unmapped(rows, lookup, "d", fold_name).collect()} == {"Atlantis", None}
    assert {r.i: r.region for r in map_values(rows, lookup, "d", "region").collect()} == dict.fromkeys(range(1, 5))


def test_a_name_with_two_targets_is_never_picked(spark):
    rows = spark.createDataFrame([("León",), ("Other",)], "d string")
    lookup = spark.createDataFrame([("Leon", "Castilla"), ("LEÓN", "Guanajuato"), ("Other", "x"), ("Half", "y"),
                                    ("half", None)], "d string, region string")
    told = {r.name: (r["names"], r.targets) for r in name_conflicts(lookup, "d", "region", fold_name).collect()}
    assert told == {"leon": (["LEÓN", "Leon"], ["Castilla", "Guanajuato"]), "half": (["Half", "half"], [None, "y"])}
    with pytest.raises(Exception, match="several targets for the name leon"):
        map_values(rows, lookup, "d", "region", fold_name).collect()
    assert name_conflicts(lookup, "d", "region").count() == 0


def versions(spark, n=4000):
    old = spark.range(n).select((F.col("id") * 3).alias("k"), F.when(F.col("id") % 11 != 0, F.col("id") % 7).alias("a"),
                                F.when(F.col("id") % 5 != 0, F.sha2(F.col("id").cast("string"), 256)).alias("b"))
    new = old.where("k % 1000 <> 999").withColumn("b", F.when(F.col("k") % 1500 == 0, F.lit("new")).otherwise(F.col("b")))
    swapped = F.col("k") == 33   # a null that changes its column
    new = new.withColumn("a", F.when(swapped, F.lit(1)).otherwise(F.col("a")))
    return old, new.union(spark.createDataFrame([(7, 1, "added"), (None, None, None)], "k long, a long, b string"))


@pytest.mark.parametrize("levels", [(8, 8), (3,), (2, 3, 4)])
def test_tree_equals_the_full_join(spark, levels):
    old, new = versions(spark)
    want = sorted(map(str, reconcile_diff(old, new, ["k"]).collect()))
    assert len(want) > 10
    assert sorted(map(str, reconcile_tree(old, new, ["k"], levels).collect())) == want
    assert reconcile_tree(old, old, ["k"], levels).count() == 0
    assert reconcile_tree(old, old.limit(0), ["k"], levels).count() == 4000


def test_few_buckets_differ_and_nulls_count(spark):
    old, new = versions(spark)
    b, c = (_hashes(x, ["k"], ["k", "a", "b"], 16) for x in (old, new))
    assert _unequal_buckets(b, c).count() <= reconcile_diff(old, new, ["k"]).count()
    two = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert _hashes(two, ["a"], ["a", "b"], 8).select("_row").distinct().count() == 2


def test_written_fact_is_pruned(spark, sf_small, tmp_path):
    star = written_star(spark, sf_small)
    months = ("1994-06", "1995-05")
    df = star_by_region_month(star, "lineitem", "revenue", months)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "GreaterThanOrEqual(calendar_key,199406)" in plan
    want = sorted(map(str, df.collect()))
    # unreadable files of the other sources don't matter
    key = star.dim_source.where("source = 'lineitem'").first().source_key
    spoilt = 0
    for name in star.fact.inputFiles():
        if f"source_key={key}/" not in name:
            with open(name.removeprefix("file://"), "r+b") as f:
                f.write(b"spoilt")
                f.truncate(6)
            spoilt += 1
    assert spoilt and sorted(map(str, star_by_region_month(star, "lineitem", "revenue", months).collect())) == want
    with pytest.raises(Exception):
        star_by_region_month(star, "orders", "total_price").collect()
