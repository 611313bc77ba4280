"""Checks: counts, totals, profiles, reconciliation, run-log audit, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.operators.joins import prefixed, same_keys
from indicata.sinks.files import materialize


# ── A1 row-count check ────────────────────────────────────────────────────

def count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``source_rows, target_rows, status`` (``OK``/``MISMATCH``).

    Two global counts evaluated as scalar subqueries of one plan.
    """
    s = source.select(F.count(F.lit(1))).scalar()
    t = target.select(F.count(F.lit(1))).scalar()
    one = source.sparkSession.range(1)
    return one.select(s.alias("source_rows"), t.alias("target_rows"),
                      F.when(s == t, F.lit("OK")).otherwise(F.lit("MISMATCH")).alias("status"))


# ── A2 rows per group with running total ──────────────────────────────────

def progress(df: DataFrame, group_cols: list[str], order_cols: list[Column]) -> DataFrame:
    """Rows per group and the running total in request order.

    The count is a normal (partially combined) aggregate; the running total is
    a window over the aggregated groups only, which are few by nature
    (regions x years) — that single ordered partition stays small.
    """
    counted = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("running_rows", F.sum("rows").over(w))


# ── A4 filter, group, count ───────────────────────────────────────────────

def filter_group_count(df: DataFrame, predicate: Column, group_cols: list[str]) -> DataFrame:
    return df.where(predicate).groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"))


# ── A5 totals per group ───────────────────────────────────────────────────

def totals(df: DataFrame, group_cols: list[str], sums: dict[str, Column]) -> DataFrame:
    """Row count and exact (decimal) sums per group."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_rows"), *[v.alias(k) for k, v in sums.items()])


def totals_vs_expected(actual: DataFrame, expected: DataFrame, keys: list[str],
                       measures: list[str]) -> DataFrame:
    """Join actual and expected totals (full outer, NULL groups match) and flag
    each group."""
    a = actual.select(*keys, F.lit(True).alias("_in"), *[F.col(m).alias(f"actual_{m}") for m in measures])
    e = prefixed(expected.select(*keys, *[F.col(m).alias(f"expected_{m}") for m in measures]), keys)
    j = a.join(e, same_keys(keys), "full").select(
        *[F.when(F.col("_in"), F.col(k)).otherwise(F.col(f"_other_{k}")).alias(k) for k in keys],
        *[f"{side}_{m}" for m in measures for side in ("actual", "expected")])
    ok = reduce(lambda x, y: x & y,
                [F.col(f"actual_{m}").eqNullSafe(F.col(f"expected_{m}")) for m in measures])
    return j.withColumn("status", F.when(ok, F.lit("OK")).otherwise(F.lit("MISMATCH")))


# ── A7 column profile ─────────────────────────────────────────────────────

def column_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True,
                   rsd: float = 0.01) -> DataFrame:
    """One row per column: rows, non-null, empty-text and distinct counts.

    ``exact=True``: values are stacked to ``(column_name, value)`` text pairs
    and counted with one two-level aggregate (distinct values per column
    first, combined map side), so no single task ever holds a column's value
    set; the shuffle carries each task's distinct values.
    ``exact=False``: one aggregate pass with HyperLogLog distinct counts
    (relative error ``rsd``); the shuffle carries one small row per task,
    whatever the data volume.
    """
    cols = columns or df.columns
    if not exact:
        aggs = []
        for i, c in enumerate(cols):
            v = F.col(f"`{c}`").cast("string")
            aggs += [F.count(v).alias(f"nn{i}"), F.count_if(v == "").alias(f"ne{i}"),
                     F.approx_count_distinct(v, rsd).alias(f"nd{i}")]
        wide = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
        rows = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                         F.col("n").cast("bigint").alias("n_rows"),
                         F.col(f"nn{i - 1}").cast("bigint").alias("n_non_null"),
                         F.col(f"ne{i - 1}").cast("bigint").alias("n_empty"),
                         F.col(f"nd{i - 1}").cast("bigint").alias("n_distinct"))
                for i, c in enumerate(cols, 1)]
        return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                 F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(cols, 1)
    ])).alias("p")).select("p.*")
    per_value = pairs.groupBy("ordinal", "column_name", "v").agg(F.count(F.lit(1)).alias("k"))
    # a row of count 0 for each column, so that an empty table has a profile
    seeds = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("v"),
                 F.lit(0).cast("bigint").alias("k")) for i, c in enumerate(cols, 1)])).alias("p")).select("p.*")
    per_value = per_value.unionByName(seeds)
    return (per_value.groupBy("ordinal", "column_name").agg(
        F.sum("k").cast("bigint").alias("n_rows"),
        F.sum(F.when(F.col("v").isNotNull(), F.col("k")).otherwise(0)).cast("bigint").alias("n_non_null"),
        F.sum(F.when(F.col("v") == "", F.col("k")).otherwise(0)).cast("bigint").alias("n_empty"),
        F.count("v").cast("bigint").alias("n_distinct")))


# ── A8 run-log audit ──────────────────────────────────────────────────────

def log_audit(log: DataFrame, run_col: str, ts_col: str, state_col: str,
              tiebreak: str | None = None) -> DataFrame:
    """Per run: last state (by ts, then tiebreak), first/last ts, duration and
    number of events.  ``max_by`` over a struct key is an ordinary aggregate,
    so a run with very many events is combined map side, never sorted whole.
    """
    order = F.struct(F.col(ts_col), F.col(tiebreak)) if tiebreak else F.col(ts_col)
    return log.groupBy(run_col).agg(
        F.max_by(F.col(state_col), order).alias("last_state"),
        F.min(ts_col).alias("started"),
        F.max(ts_col).alias("ended"),
        (F.unix_micros(F.max(ts_col).cast("timestamp"))
         - F.unix_micros(F.min(ts_col).cast("timestamp"))).alias("duration_us"),
        F.count(F.lit(1)).alias("n_events"))


# ── J4 reconciliation ─────────────────────────────────────────────────────

def reconcile_diff(baseline: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed content diff: ``keys…, change`` in ``added``/``removed``/``changed``.

    One full outer join on the key (both sides shuffled once on it); keys and
    the other columns are compared null-safe.  The key must identify a
    row on each side (a table's key): then every key meets at most one
    partner and nothing multiplies.  For data without such a key use
    ``reconcile_exact``, a multiset difference computed by aggregation.
    """
    others = [c for c in baseline.columns if c not in keys]
    b = baseline.select(*keys, F.struct(*others).alias("_b"), F.lit(True).alias("_in_b"))
    c = current.select(*keys, F.struct(*others).alias("_c"), F.lit(True).alias("_in_c"))
    j = b.join(prefixed(c, keys), same_keys(keys), "full").select(
        *[F.when(F.col("_in_b"), F.col(k)).otherwise(F.col(f"_other_{k}")).alias(k) for k in keys],
        "_b", "_c", "_in_b", "_in_c")
    change = (F.when(F.col("_in_b").isNull(), F.lit("added"))
              .when(F.col("_in_c").isNull(), F.lit("removed"))
              .when(~F.col("_b").eqNullSafe(F.col("_c")), F.lit("changed")))
    return j.select(*keys, change.alias("change")).where(F.col("change").isNotNull())


#: Bits of the key hash that each level of ``reconcile_tree`` looks at further.
LEVELS = (8, 8)


def _hashes(df: DataFrame, keys: list[str], columns: list[str], bits: int) -> DataFrame:
    """``df`` with ``_bucket`` (the first bits of the key's hash) and ``_row``
    (a hash of the whole row, null marks included: a null alone leaves a hash
    as it is)."""
    def hashed(names: list[str]) -> Column:
        return F.xxhash64(*[x for c in names for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    return df.withColumn("_bucket", F.shiftrightunsigned(hashed(keys), 64 - bits)).withColumn("_row", hashed(columns))


def _unequal_buckets(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Buckets whose rows differ, by number and sum of the row hashes (which
    no order matters to); each side sends one row per task and bucket."""
    def summed(df: DataFrame, side: int) -> DataFrame:
        return df.select("_bucket", (F.col("_row").cast("decimal(38,0)") * side).alias("_h"), F.lit(side).alias("_n"))
    both = summed(baseline, 1).unionByName(summed(current, -1))
    return both.groupBy("_bucket").agg(F.sum("_h").alias("_h"), F.sum("_n").alias("_n")).where(
        "_h <> 0 OR _n <> 0").select("_bucket")


def reconcile_tree(baseline: DataFrame, current: DataFrame, keys: list[str],
                   levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``reconcile_diff`` for two large versions with few differences.

    Level by level, both sides are summed up to one hash per bucket of keys,
    within the buckets that differed on the level before; the full outer join
    then takes only rows of the last differing buckets.  What is shuffled
    follows the changes and the number of buckets, not the rows; each level is
    one more scan of both sides.  Two versions of a bucket that differ and
    still have the same sum of 64-bit hashes would be missed."""
    columns, bits, found = baseline.columns, 0, None
    sides = [baseline, current.select(*[f"`{c}`" for c in columns])]

    def within(df: DataFrame, bits: int) -> DataFrame:
        """Rows whose first bits lie in a differing bucket; how those few are sent is the planner's choice by size."""
        hashed = _hashes(df, keys, columns, bits)
        return hashed if found is None else hashed.withColumn("_above", F.shiftrightunsigned(
            "_bucket", bits - before)).join(found.withColumnRenamed("_bucket", "_above"), "_above", "left_semi")

    before = 0
    for more in levels:
        bits += more
        b, c = (within(df, bits) for df in sides)
        found, before = materialize(_unequal_buckets(b, c), "unequal_buckets"), bits
    b, c = (within(df, bits).select(*[f"`{x}`" for x in columns]) for df in sides)
    return reconcile_diff(b, c, keys)


def reconcile_exact(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Unkeyed diff (multiset): rows only in one side, with ``side``.

    One union with +1 and -1, one (partially combined) sum per distinct row,
    and the remainder expanded: each side is read once and shuffled once.
    """
    cols = baseline.columns
    both = baseline.withColumn("_n", F.lit(1)).unionByName(current.select(*cols).withColumn("_n", F.lit(-1)))
    left = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return left.select(*cols, F.when(F.col("_n") > 0, F.lit("removed")).otherwise(F.lit("added")).alias("side"),
                       F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))).alias("_i")).drop("_i")


# ── L1 sample ─────────────────────────────────────────────────────────────

def sample_rows(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a total order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order_cols).limit(n)
