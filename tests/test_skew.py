"""One key holding a third of all rows: results stay whole and exact, and
the plans split or pre-aggregate the hot group instead of sending it whole
to one task."""

import contextlib

from pyspark.sql import functions as F

from indicata.operators.quality import log_audit
from indicata.operators.silver import dedup_latest


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot(spark, n=60_000):
    """``n`` rows; key 0 holds a third of them.  Each row carries a barely
    compressible payload, so a third of the rows is a third of the bytes."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") % 97).cast("double").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))


def test_hot_key_dedup_is_cut_map_side(spark):
    df = hot(spark)
    out = dedup_latest(df, ["k"], ["seq"])
    assert out.count() == 40_001                                    # one row per key (40,000 + the hot one)
    assert out.where("k = 0").first().seq == 59_997                # newest of the hot key
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_aggregate_combines_before_shuffle(spark):
    df = hot(spark).withColumn("ts", F.timestamp_seconds("seq")).withColumn(
        "state", F.when(F.col("seq") % 2 == 0, F.lit("a")).otherwise(F.lit("b")))
    out = log_audit(df, "k", "ts", "state", "seq")
    row = out.where("k = 0").first()
    assert row.n_events == 20_000 and row.last_state == "b"         # 59997 is odd
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_hot_customer_series_exact(spark, tmp_path):
    """A third of all orders on one customer: the per-region monthly totals
    stay exact, and the customer join splits that customer's orders."""
    import datetime as dt

    from indicata.plans.series import orders_by_region
    from indicata.tables import Tables

    base = str(tmp_path)
    spark.createDataFrame([(0, "EUROPE"), (1, "ASIA")], "r_regionkey int, r_name string") \
        .write.parquet(f"{base}/region.parquet")
    spark.createDataFrame([(i, f"N{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int") \
        .write.parquet(f"{base}/nation.parquet")
    spark.range(1000).select(F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"),
                             (F.col("id") % 4).cast("int").alias("c_nationkey"), F.lit(0.0).alias("c_acctbal"),
                             F.lit("S").alias("c_mktsegment")).write.parquet(f"{base}/customer.parquet")
    orders = spark.range(30_000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), (F.col("id") % 100 + 0.25).alias("o_totalprice"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    orders.repartition(8).write.parquet(f"{base}/orders.parquet")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                        "spark.sql.shuffle.partitions": "16"}):
        joined = orders_by_region(Tables(spark, base))
        got = {(r.region, r.period): r.value for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "skew=true" in plan      # the hot partition is split
    # direct computation
    o, c = spark.read.parquet(f"{base}/orders.parquet"), spark.read.parquet(f"{base}/customer.parquet")
    n, g = spark.read.parquet(f"{base}/nation.parquet"), spark.read.parquet(f"{base}/region.parquet")
    want = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(g, n.n_regionkey == g.r_regionkey)
            .groupBy(F.col("r_name").alias("region"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("v")).collect())
    assert got == {(r.region, r.period): r.v for r in want}
    assert sum(got.values()) == sum(i % 100 + 0.25 for i in range(30_000))
    assert all(isinstance(p, dt.date) for _, p in got)
