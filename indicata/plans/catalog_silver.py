"""Catalog: Silver — typing, cleansing, reshaping, dedup, mapping, checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions import float_text, fold_name, safe_rate
from indicata.operators.joins import broadcast_reference, upsert
from indicata.operators.quality import (column_profile, count_check, filter_group_count,
                                        log_audit, progress, reconcile_diff, reconcile_exact, reconcile_tree, sample_rows,
                                        totals, totals_vs_expected)
from indicata.operators import sketches
from indicata.operators.silver import (apply_scope, cleanse_text, consolidate, dedup_exact,
                                       dedup_latest, enforce_types, map_values, name_conflicts, reject_rows,
                                       typed_rows, unmapped, unpivot_measures, verify_types)
from indicata.session import scratch_path
from indicata.sinks import versions
from indicata.plans.catalog import (EVENTS_BY_TYPE_SQL, LINEITEM_BY_REGION_SQL, ORDERS_BY_REGION_SQL, REGISTRY,
                                    query, tables)

# ── P10 type enforcement ──────────────────────────────────────────────────
# Landed text for events, dirtied by fixed rules: a decimal comma, a
# placeholder and a suffixed user id, so every rejection path is exercised.

EVENTS_TEXT_SQL = """
  SELECT event_id,
         CASE WHEN event_id % 17 = 0 THEN CAST(user_id AS VARCHAR) || 'x' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_id % 13 = 0 THEN 'n/a'
              WHEN event_id % 7 = 0 THEN replace(CAST(value AS VARCHAR), '.', ',')
              ELSE CAST(value AS VARCHAR) END AS value,
         CASE WHEN event_id % 19 = 0 THEN strftime(ts, '%d/%m/%Y') ELSE strftime(ts, '%Y-%m-%d') END AS day
  FROM events
"""

EVENTS_CONTRACT = {"user_id": "bigint", "value": "decimal(18,4)", "day": "date"}


def _events_text(t):
    e = t.events
    uid = F.col("user_id").cast("string")
    val = float_text("value")
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 17 == 0, F.concat(uid, F.lit("x"))).otherwise(uid).alias("user_id"),
        F.when(F.col("event_id") % 13 == 0, F.lit("n/a"))
         .when(F.col("event_id") % 7 == 0, F.regexp_replace(val, r"\.", ","))
         .otherwise(val).alias("value"),
        F.when(F.col("event_id") % 19 == 0, F.date_format("ts", "dd/MM/yyyy"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"))


@query("enforce_types", f"""
SELECT event_id, TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(value AS DECIMAL(18,4)) AS value,
       TRY_CAST(day AS DATE) AS day
FROM ({EVENTS_TEXT_SQL})
""")
def enforce_types_q(spark, base):
    return typed_rows(enforce_types(_events_text(tables(spark, base)), EVENTS_CONTRACT))


@query("type_rejects", f"""
WITH x AS ({EVENTS_TEXT_SQL})
SELECT event_id, 'user_id' AS "column", user_id AS raw, 'bigint' AS target FROM x
 WHERE TRY_CAST(user_id AS BIGINT) IS NULL AND NULLIF(trim(user_id), '') IS NOT NULL
UNION ALL
SELECT event_id, 'value', value, 'decimal(18,4)' FROM x
 WHERE TRY_CAST(value AS DECIMAL(18,4)) IS NULL AND NULLIF(trim(value), '') IS NOT NULL
UNION ALL
SELECT event_id, 'day', day, 'date' FROM x
 WHERE TRY_CAST(day AS DATE) IS NULL AND NULLIF(trim(day), '') IS NOT NULL
""")
def type_rejects_q(spark, base):
    return reject_rows(enforce_types(_events_text(tables(spark, base)), EVENTS_CONTRACT), ["event_id"])


# ── P11 cleansing ─────────────────────────────────────────────────────────

@query("cleanse_text", """
WITH d AS (
  SELECT p_partkey,
         CASE p_partkey % 5 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN replace(p_name, ' ', '   ')
              WHEN 2 THEN ' n/a ' WHEN 3 THEN '' ELSE p_name END AS raw
  FROM part),
c AS (SELECT p_partkey, raw, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS s FROM d)
SELECT p_partkey, raw,
       CASE WHEN upper(s) IN ('', '-', '.', '..', '...', 'NA', 'N/A', 'NULL', 'NONE', 'NAN') THEN NULL ELSE s END AS cleansed
FROM c
""")
def cleanse_text_q(spark, base):
    p = tables(spark, base).part
    k = F.col("p_partkey") % 5
    raw = (F.when(k == 0, F.concat(F.lit("  "), "p_name", F.lit(" ")))
           .when(k == 1, F.regexp_replace("p_name", " ", "   "))
           .when(k == 2, F.lit(" n/a ")).when(k == 3, F.lit("")).otherwise(F.col("p_name")))
    return p.select("p_partkey", raw.alias("raw")).withColumn("cleansed", cleanse_text("raw"))


# ── P12 type verification ─────────────────────────────────────────────────

ORDERS_CONTRACT = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DecimalType(18, 2)),
    T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_clerk", T.StringType()),
])


@query("type_verification", """
WITH b AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 9 = 0 THEN replace(CAST(o_totalprice AS VARCHAR), '.', ',')
              ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
  FROM orders)
SELECT 1 AS ordinal, 'o_orderkey' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type, true AS type_ok,
       count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count,
       count(*) FILTER (WHERE o_orderkey IS NOT NULL AND TRY_CAST(o_orderkey AS BIGINT) IS NULL) AS cast_failures FROM b
UNION ALL
SELECT 2, 'o_custkey', 'bigint', 'string', false,
       count(*) FILTER (WHERE o_custkey IS NULL),
       count(*) FILTER (WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS BIGINT) IS NULL) FROM b
UNION ALL
SELECT 3, 'o_orderstatus', 'string', 'string', true,
       count(*) FILTER (WHERE o_orderstatus IS NULL), 0 FROM b
UNION ALL
SELECT 4, 'o_totalprice', 'decimal(18,2)', 'string', false,
       count(*) FILTER (WHERE o_totalprice IS NULL),
       count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(18,2)) IS NULL) FROM b
UNION ALL
SELECT 5, 'o_orderdate', 'date', 'string', false,
       count(*) FILTER (WHERE o_orderdate IS NULL),
       count(*) FILTER (WHERE o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS DATE) IS NULL) FROM b
UNION ALL
SELECT 6, 'o_clerk', 'string', NULL, false, NULL, NULL
""")
def type_verification_q(spark, base):
    o = tables(spark, base).orders
    price = float_text("o_totalprice")
    b = o.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 9 == 0, F.regexp_replace(price, r"\.", ",")).otherwise(price)
         .alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"))
    return verify_types(b, ORDERS_CONTRACT)


# ── P13 run scope ─────────────────────────────────────────────────────────

@query("scope_since", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'")
def scope_since(spark, base):
    return apply_scope(tables(spark, base).orders, "o_orderdate", "since=1999-01")


# ── R2 unpivot ────────────────────────────────────────────────────────────

@query("unpivot_measures", """
SELECT l_orderkey, l_linenumber, measure, value FROM (
  SELECT l_orderkey, l_linenumber,
         CAST(l_quantity AS DECIMAL(18,4)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS l_extendedprice,
         CAST(l_discount AS DECIMAL(18,4)) AS l_discount, CAST(l_tax AS DECIMAL(18,4)) AS l_tax
  FROM lineitem)
UNPIVOT INCLUDE NULLS (value FOR measure IN (l_quantity, l_extendedprice, l_discount, l_tax))
""")
def unpivot_measures_q(spark, base):
    return unpivot_measures(tables(spark, base).lineitem, ["l_orderkey", "l_linenumber"],
                            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


# ── R4 consolidation of differently shaped parts ─────────────────────────

@query("consolidate_files", """
SELECT * FROM (
  SELECT o_orderkey, o_custkey, o_totalprice, 'estado' AS contracting_agent, false AS is_continuation
  FROM orders WHERE o_orderkey % 4 = 0
  UNION ALL BY NAME
  SELECT o_orderkey, o_custkey, o_orderdate, 'estado' AS contracting_agent, true AS is_continuation
  FROM orders WHERE o_orderkey % 4 = 1
  UNION ALL BY NAME
  SELECT o_orderkey, o_orderstatus, o_totalprice, 'entes' AS contracting_agent, false AS is_continuation
  FROM orders WHERE o_orderkey % 4 = 2
  UNION ALL BY NAME
  SELECT o_orderkey, o_orderpriority, o_orderdate, 'entes' AS contracting_agent, true AS is_continuation
  FROM orders WHERE o_orderkey % 4 = 3)
""")
def consolidate_files(spark, base):
    """Four landed parts (two agents x first/continuation file) with different
    columns, consolidated by name; the split rule only shapes the fixture."""
    o = tables(spark, base).orders
    shapes = [
        (0, ["o_orderkey", "o_custkey", "o_totalprice"], "estado", False),
        (1, ["o_orderkey", "o_custkey", "o_orderdate"], "estado", True),
        (2, ["o_orderkey", "o_orderstatus", "o_totalprice"], "entes", False),
        (3, ["o_orderkey", "o_orderpriority", "o_orderdate"], "entes", True),
    ]
    parts = [o.where(F.col("o_orderkey") % 4 == r).select(
        *cols, F.lit(agent).alias("contracting_agent"), F.lit(cont).alias("is_continuation"))
        for r, cols, agent, cont in shapes]
    return consolidate(parts)


# ── A6 deduplication ─────────────────────────────────────────────────────

@query("dedup_latest", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
""")
def dedup_latest_q(spark, base):
    return dedup_latest(tables(spark, base).lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("dedup_exact", "SELECT DISTINCT * FROM lineitem")
def dedup_exact_q(spark, base):
    return dedup_exact(tables(spark, base).lineitem)


# ── J2 delegation -> region mapping ──────────────────────────────────────
# The lookup covers every nation except those of one region, so the unmapped
# report has content.

DELEGATION_MAP_SQL = """
  SELECT n_name AS delegation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'MIDDLE EAST'
"""


def _delegations(t):
    names = t.nation.select("n_nationkey", F.col("n_name").alias("delegation"))
    return (t.supplier.select("s_suppkey", "s_nationkey")
            .join(broadcast_reference(names), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "delegation"))


def _delegation_map(t):
    return (t.nation.join(broadcast_reference(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .where(F.col("r_name") != "MIDDLE EAST")
            .select(F.col("n_name").alias("delegation"), F.col("r_name").alias("region")))


@query("map_region", f"""
SELECT s.s_suppkey, n.n_name AS delegation, m.region
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN ({DELEGATION_MAP_SQL}) m ON n.n_name = m.delegation
""")
def map_region(spark, base):
    t = tables(spark, base)
    return map_values(_delegations(t), _delegation_map(t), "delegation", "region") \
        .select("s_suppkey", "delegation", "region")


@query("unmapped_regions", f"""
SELECT n.n_name AS delegation, count(*) AS n_rows
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE NOT EXISTS (SELECT 1 FROM ({DELEGATION_MAP_SQL}) m WHERE m.delegation = n.n_name)
GROUP BY n.n_name
""")
def unmapped_regions(spark, base):
    t = tables(spark, base)
    return unmapped(_delegations(t), _delegation_map(t), "delegation")


@query("map_folded", f"""
SELECT s.s_suppkey, m.region FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN ({DELEGATION_MAP_SQL}) m ON n.n_name = m.delegation
""")
def map_folded(spark, base):
    """Suppliers' nations in several spellings (accents composed or not, case, articles before or after), resolved by
    a lookup that has spellings of its own and repeats entries."""
    t, k, name = tables(spark, base), F.col("s_suppkey") % 4, F.initcap("delegation")
    spelt = (F.when(k == 0, F.concat(F.lit("La "), F.translate(name, "aeiou", "áèîöū")))
             .when(k == 1, F.concat(F.regexp_replace(F.upper(name), "([AEIOU])", "$1\u0301"), F.lit(" (El)")))
             .when(k == 2, F.concat(name, F.lit(", Los"))).otherwise(F.concat(F.lit(" "), F.col("delegation"))))
    own = _delegation_map(t)
    lookup = own.union(own.select(F.concat(F.lit("Las "), F.lower("delegation")).alias("delegation"), "region"))
    return map_values(_delegations(t).withColumn("delegation", spelt), lookup, "delegation", "region", fold_name) \
        .select("s_suppkey", "region")


@query("map_conflicts", """
SELECT replace(lower(n_name), '_', ' ') AS name, r_name || '|another region' AS targets
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST' AND n_nationkey % 5 = 0
""")
def map_conflicts(spark, base):
    """Names that a lookup maps to two regions under different spellings."""
    t = tables(spark, base)
    own = _delegation_map(t)
    wrong = own.join(t.nation, own["delegation"] == t.nation["n_name"]).where("n_nationkey % 5 = 0").select(
        F.concat(F.lit("El "), F.initcap("delegation")).alias("delegation"), F.lit("another region").alias("region"))
    found = name_conflicts(own.union(wrong), "delegation", "region", fold_name)
    return found.select("name", F.array_join("targets", "|").alias("targets"))


# ── J5 upsert ────────────────────────────────────────────────────────────

CUSTOMER_UPDATES_SQL = """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey + 10000000, 'New ' || c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
"""


@query("merge_partitions", """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, year(o_orderdate) AS year FROM orders),
u AS (SELECT o_orderkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, year FROM o
      WHERE year IN (1995, 1997) AND o_orderkey % 10 = 0
      UNION ALL SELECT -o_orderkey, 'N', o_totalprice, year FROM o WHERE year = 1996 AND o_orderkey % 10 = 1)
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(year AS INTEGER) AS year FROM o
WHERE (o_orderkey, year) NOT IN (SELECT o_orderkey, year FROM u)
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(year AS INTEGER) FROM u
""")
def merge_partitions(spark, base):
    """``orders`` as a versioned table by year, then updates and new rows of three years: only these are rewritten."""
    o = tables(spark, base).orders.select("o_orderkey", "o_orderstatus", "o_totalprice",
                                          F.year("o_orderdate").alias("year"))
    root = scratch_path(spark, "merge_partitions")
    versions.overwrite(o, root, ["year"])
    changed = o.where(F.col("year").isin(1995, 1997) & (F.col("o_orderkey") % 10 == 0)).select(
        "o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"), "year")
    added = o.where((F.col("year") == 1996) & (F.col("o_orderkey") % 10 == 1)).select(
        (-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice", "year")
    versions.merge(changed.unionByName(added), root, ["o_orderkey", "year"])
    return versions.read(spark, root)


@query("merge_upsert", f"""
WITH u AS ({CUSTOMER_UPDATES_SQL})
SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.c_custkey = c.c_custkey)
UNION ALL SELECT * FROM u
""")
def merge_upsert(spark, base):
    c = tables(spark, base).customer
    updates = (c.where(F.col("c_mktsegment") == "BUILDING")
               .withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100.0))
               .unionByName(c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
                   (F.col("c_custkey") + F.lit(10_000_000)).alias("c_custkey"),
                   F.concat(F.lit("New "), "c_name").alias("c_name"), "c_nationkey", "c_acctbal",
                   "c_mktsegment")))
    return upsert(c, updates, ["c_custkey"])


# ── J4 / A1 reconciliation ───────────────────────────────────────────────

CURRENT_ORDERS_SQL = """
  SELECT * FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
    AND o_orderpriority <> '1-URGENT'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '2-HIGH'
"""


def _current_orders(o):
    """A later version of ``orders``: some rows removed, some changed, some added."""
    keep = o.where(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"))
                   & (F.col("o_orderpriority") != "1-URGENT"))
    changed = o.where(F.col("o_orderpriority") == "1-URGENT").withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    added = o.where(F.col("o_orderpriority") == "2-HIGH").withColumn(
        "o_orderkey", F.col("o_orderkey") + F.lit(10_000_000))
    return keep.unionByName(changed).unionByName(added)


@query("reconcile_counts", f"""
SELECT (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(*) FROM ({CURRENT_ORDERS_SQL})) AS target_rows,
       CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM ({CURRENT_ORDERS_SQL}))
            THEN 'OK' ELSE 'MISMATCH' END AS status
""")
def reconcile_counts(spark, base):
    o = tables(spark, base).orders
    return count_check(o, _current_orders(o))


@query("reconcile_diff", f"""
WITH c AS ({CURRENT_ORDERS_SQL})
SELECT COALESCE(b.o_orderkey, c.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN c.o_orderkey IS NULL THEN 'removed'
            ELSE 'changed' END AS change
FROM orders b FULL JOIN c ON b.o_orderkey = c.o_orderkey
WHERE b.o_orderkey IS NULL OR c.o_orderkey IS NULL
   OR b.o_custkey IS DISTINCT FROM c.o_custkey OR b.o_orderstatus IS DISTINCT FROM c.o_orderstatus
   OR b.o_totalprice IS DISTINCT FROM c.o_totalprice OR b.o_orderdate IS DISTINCT FROM c.o_orderdate
   OR b.o_orderpriority IS DISTINCT FROM c.o_orderpriority
""")
def reconcile_diff_q(spark, base):
    o = tables(spark, base).orders
    return reconcile_diff(o, _current_orders(o), ["o_orderkey"])


@query("reconcile_tree", REGISTRY["reconcile_diff"][1])
def reconcile_tree_q(spark, base):
    """The same differences, found level by level through hashes of key buckets."""
    o = tables(spark, base).orders
    return reconcile_tree(o, _current_orders(o), ["o_orderkey"])


@query("version_diff", f"""
WITH c AS ({CURRENT_ORDERS_SQL})
SELECT *, 'removed' AS side FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM c)
UNION ALL
SELECT *, 'added' AS side FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM orders)
""")
def version_diff(spark, base):
    """Unkeyed difference of two versions (multiset, both directions)."""
    o = tables(spark, base).orders
    return reconcile_exact(o, _current_orders(o))


# ── A2, A4, A5, A7, A8, L1 ───────────────────────────────────────────────

@query("ingest_progress", """
WITH g AS (SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows
           FROM orders GROUP BY ALL)
SELECT o_orderstatus, year, rows,
       CAST(SUM(rows) OVER (ORDER BY o_orderstatus, year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS running_rows
FROM g
""")
def ingest_progress(spark, base):
    o = tables(spark, base).orders.withColumn("year", F.year("o_orderdate"))
    return progress(o, ["o_orderstatus", "year"], [F.col("o_orderstatus"), F.col("year")]) \
        .withColumn("running_rows", F.col("running_rows").cast("bigint"))


@query("filter_group_count",
       "SELECT event_type, count(*) AS n FROM events WHERE value >= 100 GROUP BY event_type")
def filter_group_count_q(spark, base):
    return filter_group_count(tables(spark, base).events, F.col("value") >= 100, ["event_type"])


@query("totals_by_source", """
SELECT l_returnflag, count(*) AS n_rows,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sum_price
FROM lineitem GROUP BY l_returnflag
""")
def totals_by_source(spark, base):
    li = tables(spark, base).lineitem
    return totals(li, ["l_returnflag"], {
        "sum_qty": F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)"),
        "sum_price": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)"),
    })


def _profile_sql(cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols, 1):
        parts.append(
            f"SELECT {i} AS ordinal, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_non_null, "
            f"count(*) FILTER (WHERE CAST({c} AS VARCHAR) = '') AS n_empty, "
            f"count(DISTINCT {c}) AS n_distinct FROM customer")
    return "\nUNION ALL\n".join(parts)


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("column_profile", _profile_sql(CUSTOMER_COLUMNS))
def column_profile_q(spark, base):
    return column_profile(tables(spark, base).customer, CUSTOMER_COLUMNS)


@query("profile_merged", """
WITH n AS (SELECT 'event_type' AS column_name, count(*) AS n_rows, count(event_type) AS n_values FROM events
           UNION ALL SELECT 'user_id', count(*), count(user_id) FROM events
           UNION ALL SELECT 'value', count(*), count(value) FROM events),
f AS (SELECT event_type, count(*) AS k FROM events GROUP BY 1 ORDER BY k DESC, event_type LIMIT 1)
SELECT n.*, CASE WHEN column_name = 'event_type' THEN (SELECT event_type FROM f) END AS most_frequent,
       CASE WHEN column_name = 'event_type' THEN (SELECT k FROM f) END AS its_count,
       true AS distinct_close, CASE WHEN column_name <> 'event_type' THEN true END AS median_close FROM n
""")
def profile_merged(spark, base):
    """Profile of ``events`` from stored sketches per month: all months but the last first, then the last alone; the
    estimates are compared with exact figures."""
    e, columns = tables(spark, base).events.withColumn("month", F.date_format("ts", "yyyy-MM")), [
        "event_type", "user_id", "value"]
    path, last = scratch_path(spark, "profile_sketches"), e.agg(F.max("month")).first()[0]
    for part in (e.where(F.col("month") != last), e.where(F.col("month") == last)):
        sketches.store(sketches.sketch(part, "month", columns), path)
    found = sketches.merged(spark.read.parquet(path))
    none = F.lit(None).cast("array<double>")
    exact = e.agg(*[F.count_distinct(c).alias(f"{c}_d") for c in columns],
                  *[F.percentile(F.col(c).cast("double"), F.array(F.lit(0.45), F.lit(0.55))).alias(f"{c}_m")
                    for c in columns[1:]])
    exact = exact.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_d").alias("d"), (F.col(f"{c}_m") if i else none).alias("m"))
        for i, c in enumerate(columns)])).alias("x")).select("x.*")
    first = F.when(F.col("column_name") == "event_type", F.col("frequent")[0])
    return found.join(exact, "column_name").select(
        "column_name", "n_rows", "n_values", first["value"].alias("most_frequent"), first["low"].alias("its_count"),
        (F.abs(F.col("n_distinct") - F.col("d")) <= 0.06 * F.col("d") + 1).alias("distinct_close"),
        F.col("quantiles")[1].between(F.col("m")[0], F.col("m")[1]).alias("median_close"))


@query("log_audit", """
SELECT user_id, (array_agg(event_type ORDER BY ts DESC, event_id DESC))[1] AS last_state,
       min(ts) AS started, max(ts) AS ended, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us,
       count(*) AS n_events
FROM events GROUP BY user_id
""")
def log_audit_q(spark, base):
    return log_audit(tables(spark, base).events, "user_id", "ts", "event_type", "event_id")


@query("sample_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def sample_rows_q(spark, base):
    return sample_rows(tables(spark, base).orders, ["o_orderkey"], 5)


# ── F9 guarded rate ──────────────────────────────────────────────────────

@query("safe_rate", """
SELECT l_orderkey,
       ROUND(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE)
             / NULLIF(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE), 0),
             6) AS discount_to_tax
FROM lineitem GROUP BY l_orderkey
""")
def safe_rate_q(spark, base):
    li = tables(spark, base).lineitem
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    g = li.groupBy("l_orderkey").agg(
        F.sum(price * F.col("l_discount").cast("decimal(18,2)")).alias("d"),
        F.sum(price * F.col("l_tax").cast("decimal(18,2)")).alias("t"))
    return g.select("l_orderkey", safe_rate("d", "t").alias("discount_to_tax"))


# ── A5 fact totals per source against the sources ───────────────────────

@query("totals_vs_expected", f"""
WITH f AS ({ORDERS_BY_REGION_SQL} UNION ALL {LINEITEM_BY_REGION_SQL} UNION ALL {EVENTS_BY_TYPE_SQL}),
a AS (SELECT source, CAST(SUM(value) AS DECIMAL(18,4)) AS total FROM f GROUP BY source),
e AS (
  SELECT 'orders' AS source, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS total FROM orders
  UNION ALL
  SELECT 'lineitem', CAST(SUM(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
                               AS DECIMAL(18,4))) AS DECIMAL(18,4)) FROM lineitem
  UNION ALL
  SELECT 'events', CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,4)) FROM events)
SELECT COALESCE(a.source, e.source) AS source, a.total AS actual_total, e.total AS expected_total,
       CASE WHEN a.total IS NOT DISTINCT FROM e.total THEN 'OK' ELSE 'MISMATCH' END AS status
FROM a FULL JOIN e ON a.source = e.source
""")
def totals_vs_expected_q(spark, base):
    """Totals of the consolidated monthly fact per source, checked against
    totals computed straight from each source table."""
    from indicata.operators.silver import VALUE_TYPE
    from indicata.plans import series

    t = tables(spark, base)
    fact = consolidate([series.orders_by_region(t), series.lineitem_by_region(t), series.events_by_type(t)])
    actual = fact.groupBy("source").agg(F.sum("value").cast(VALUE_TYPE).alias("total"))
    li = t.lineitem
    expected = (t.orders.agg(F.sum(F.col("o_totalprice").cast(VALUE_TYPE)).cast(VALUE_TYPE).alias("total"))
                .select(F.lit("orders").alias("source"), "total")
                .unionByName(li.agg(F.sum((F.col("l_extendedprice").cast("decimal(18,2)")
                                           * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")))
                                          .cast(VALUE_TYPE)).cast(VALUE_TYPE).alias("total"))
                             .select(F.lit("lineitem").alias("source"), "total"))
                .unionByName(t.events.agg(F.sum(F.col("value").cast(VALUE_TYPE)).cast(VALUE_TYPE).alias("total"))
                             .select(F.lit("events").alias("source"), "total")))
    return totals_vs_expected(actual, expected, ["source"], ["total"]).select(
        "source", F.col("actual_total"), F.col("expected_total"), "status")
