"""A7/A1 — profiles that merge: small summaries per partition, stored once and put together without rereading.

Per partition and column: rows, values, empty texts, least and greatest text,
a HyperLogLog sketch (distinct values), a KLL sketch (quantiles of numbers) and
the most frequent values with the greatest count left out.  A merge adds the
counts up exactly, unites the sketches, and gives each frequent value a lower
and an upper bound of its count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Sizes of the sketches: 2 ** LG_K registers (relative error about 1.04 / sqrt(2 ** LG_K)), KLL_K items a level (rank
#: error about 1 %), and frequent values kept per partition.
LG_K, KLL_K, TOP = 12, 200, 64


def sketch(df: DataFrame, part: str, columns: list[str], top: int = TOP) -> DataFrame:
    """One row per value of ``part`` (NULL included) and column: ``part,
    column_name, n_rows, n_values, n_empty, least, greatest, distinct, ranks,
    frequent, left_out``.

    Sketches and counts are built map side, so a shuffle carries a row per
    task and partition, whatever the data; frequent values are counted per
    (partition, column, value) first and cut to ``top`` before they move on."""
    def text(c: str) -> Column:
        return F.col(f"`{c}`").cast("string")

    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        number = isinstance(df.schema[c].dataType, NumericType)
        ranks = F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), F.lit(KLL_K)) if number else F.lit(None).cast(
            "binary")
        aggs += [F.count(F.col(f"`{c}`")).alias(f"v{i}"), F.count_if(text(c) == "").alias(f"e{i}"),
                 F.min(text(c)).alias(f"a{i}"), F.max(text(c)).alias(f"z{i}"),
                 F.hll_sketch_agg(text(c), F.lit(LG_K)).alias(f"d{i}"), (F.max(F.lit(None).cast("binary")) if not number
                                                                        else ranks).alias(f"r{i}")]
    wide = df.groupBy(F.col(f"`{part}`").alias("part")).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"v{i}").alias("n_values"),
                     F.col(f"e{i}").alias("n_empty"), F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("greatest"),
                     F.col(f"d{i}").alias("distinct"), F.col(f"r{i}").alias("ranks")) for i, c in enumerate(columns)]
    narrow = wide.select("part", F.explode(F.array(*rows)).alias("x")).select("part", "x.*")
    each = df.select(F.col(f"`{part}`").alias("part"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns])).alias("x")).select("part", "x.*")
    counted = each.where("value IS NOT NULL").groupBy("part", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("part", "column_name").orderBy(F.desc("n"), "value")
    first = counted.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top + 1)
    frequent = first.groupBy("part", "column_name").agg(
        F.sort_array(F.collect_list(F.when(F.col("nth") <= top, F.struct("nth", "value", "n")))).alias("frequent"),
        F.coalesce(F.max(F.when(F.col("nth") > top, F.col("n"))), F.lit(0)).alias("left_out"))
    same = narrow["part"].eqNullSafe(frequent["part"]) & (narrow["column_name"] == frequent["column_name"])
    return narrow.join(frequent, same, "left").select(
        *[narrow[c] for c in narrow.columns], "frequent", F.coalesce("left_out", F.lit(0)).alias("left_out"))


def store(sketches: DataFrame, path: str) -> None:
    """Write sketches by partition: those of other partitions stay as they are."""
    sketches.withColumn("_part", F.coalesce(F.col("part").cast("string"), F.lit("null"))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(path)


def merged(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profile of all partitions together: ``column_name, n_rows, n_values,
    n_empty, least, greatest`` (exact), ``n_distinct`` (estimate), ``quantiles``
    (of numbers, approximate) and ``frequent``, the values that may be the most
    frequent by their lower bounds, with ``low`` <= count <= ``high``."""
    one = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.sum("n_empty").alias("n_empty"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("ranks").alias("_ranks"), F.sum("left_out").alias("_left_out"))
    points = F.array(*[F.lit(float(q)) for q in quantiles])
    has = F.coalesce(F.kll_sketch_get_n_double("_ranks"), F.lit(0)) > 0
    one = one.withColumn("quantiles", F.when(has, F.kll_sketch_get_quantile_double("_ranks", points)))
    values = sketches.select("column_name", "left_out", F.explode("frequent").alias("x")).groupBy(
        "column_name", "x.value").agg(F.sum("x.n").alias("low"), F.sum("left_out").alias("_own"))
    bounds = values.join(one.select("column_name", "_left_out"), "column_name").select(
        "column_name", "value", "low", (F.col("low") + F.col("_left_out") - F.col("_own")).alias("high"))
    order = Window.partitionBy("column_name").orderBy(F.desc("low"), "value")
    best = bounds.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= TOP).groupBy("column_name").agg(
        F.sort_array(F.collect_list(F.struct("nth", "value", "low", "high"))).alias("frequent"))
    return one.drop("_ranks", "_left_out").join(best, "column_name", "left")
