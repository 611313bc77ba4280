"""Catalog: whole-layer checks on the driver tables — Bronze -> Silver for JSON
and delimited sources, Gold measures, and whole medallion runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.functions import float_text, iso_utc
from indicata.operators.bronze import all_strings, run_stamp
from indicata.plans import increments, series
from indicata.plans.bronze import bronze_delimited, bronze_energy
from indicata.plans.catalog import (EVENTS_BY_TYPE_SQL, LINEITEM_BY_REGION_SQL, ORDERS_BY_REGION_SQL, REGISTRY,
                                    query, tables)
from indicata.plans.catalog_bronze import API_PATH, RUN_TS, _landed_documents
from indicata.plans.gold import (Star, build_dims, derive_measures, keyed_fact, star_by_region_month,
                                 with_unknown)
from indicata.plans.run import RunConfig, energy_documents, run_medallion
from indicata.plans.silver import energy_history as revised
from indicata.plans.silver import reject_rows, silver_delimited, silver_energy, tidy_rows
from indicata.operators.silver import consolidate, tidy
from indicata.session import scratch_path
from indicata.sinks import versions
from indicata.sinks.files import materialize, materialize_all
from indicata.sources.csv_text import (RECORD_COL, overlong_rows, parse_records, read_delimited, read_delimited_files,
                                       well_formed, write_delimited)

# ── F4: ISO UTC text ─────────────────────────────────────────────────────

@query("iso_timestamps", """
SELECT event_id,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS ts_iso
FROM events
""")
def iso_timestamps(spark, base):
    return tables(spark, base).events.select("event_id", iso_utc("ts").alias("ts_iso"))


# ── M1 + M2: JSON documents -> Bronze -> Silver ──────────────────────────

def _exact_mean(value: str) -> str:
    """SQL: exact decimal mean of a group, half up at scale 8 and then 4, as a decimal average is cast."""
    return (f"CAST(ROUND(CAST(SUM({value}) AS DECIMAL(38,8)) * 10000 / COUNT({value})) / 10000 AS DECIMAL(18,4))")


@query("energy_tidy", f"""
SELECT 'energy' AS source, event_type AS indicator, 'chunk_' || CAST(event_id // 50 AS VARCHAR) AS region,
       CAST(date_trunc('month', ts) AS DATE) AS period, 'value' AS measure,
       CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS value
FROM events GROUP BY ALL
UNION ALL
SELECT 'energy', event_type, 'chunk_' || CAST(event_id // 50 AS VARCHAR), CAST(date_trunc('month', ts) AS DATE),
       'percentage', {_exact_mean("CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DECIMAL(18,4))")}
FROM events GROUP BY ALL
""")
def energy_tidy(spark, base):
    bronze = bronze_energy(_landed_documents(tables(spark, base)), RUN_TS, API_PATH)
    return series.monthly(tidy_rows(silver_energy(bronze)))


# ── M2: full-history re-pulls with revised, missing and repeated points ──

# load 1: all chunks, every fourth value provisional (doubled); load 2: even chunks without every fifth point;
# loads 3 and 4, equal: every third chunk
_LOADS = """
e AS (SELECT event_id, event_type, event_id // 50 AS chunk, strftime(ts, '%Y-%m-%d %H:%M:%S') AS raw_period,
             CAST(date_trunc('month', ts) AS DATE) AS period, value,
             CAST(json_extract(props, '$.k') AS INTEGER) AS share FROM events),
l AS (SELECT e.* REPLACE (CASE WHEN event_id % 4 = 0 THEN value * 2 ELSE value END AS value), 1 AS load FROM e
      UNION ALL SELECT *, 2 FROM e WHERE chunk % 2 = 0 AND event_id % 5 <> 0
      UNION ALL SELECT *, 3 FROM e WHERE chunk % 3 = 0 UNION ALL SELECT *, 4 FROM e WHERE chunk % 3 = 0)"""


def _repulled(spark, base):
    """Documents of the four loads, as they count."""
    t = tables(spark, base)
    chunk, at = F.floor(F.col("event_id") / 50), "2024-0{}-01 00:00:00"
    first = t.events.withColumn("value", F.when(F.col("event_id") % 4 == 0, F.col("value") * 2).otherwise(F.col("value")))
    loads = [first, t.events.where((chunk % 2 == 0) & (F.col("event_id") % 5 != 0)), t.events.where(chunk % 3 == 0)]
    landed = [_landed_documents(t, e).withColumn("loaded_at", F.lit(at.format(i)).cast("timestamp"))
              for i, e in enumerate([*loads, loads[2]], 1)]
    found = energy_documents(consolidate(landed), ["geo_name"]).withColumnRenamed("loaded_at", "_loaded_at")
    return silver_energy(bronze_energy(found, RUN_TS, API_PATH))


@query("energy_revisions", f"""
WITH {_LOADS},
c AS (SELECT * FROM l QUALIFY load = max(load) OVER (PARTITION BY chunk, event_type, raw_period))
SELECT 'energy' AS source, event_type AS indicator, 'chunk_' || CAST(chunk AS VARCHAR) AS region, period,
       'value' AS measure, CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS value FROM c GROUP BY ALL
UNION ALL
SELECT 'energy', event_type, 'chunk_' || CAST(chunk AS VARCHAR), period, 'percentage',
       {_exact_mean("CAST(share AS DECIMAL(18,4))")} FROM c GROUP BY ALL
""")
def energy_revisions(spark, base):
    """``events`` landed four times as documents, with provisional values first: what counts per month."""
    return series.monthly(tidy_rows(_repulled(spark, base)))


@query("energy_history", f"""
WITH {_LOADS},
v AS (SELECT event_type, chunk, raw_period, load, 'value' AS measure, CAST(value AS VARCHAR) AS raw FROM l
      UNION ALL SELECT event_type, chunk, raw_period, load, 'percentage', CAST(share AS VARCHAR) FROM l),
g AS (SELECT event_type, chunk, raw_period, measure, load, list(raw ORDER BY raw NULLS FIRST) AS raws FROM v GROUP BY ALL),
n AS (SELECT *, lag(raws) OVER w AS before, lag(load) OVER w AS earlier FROM g
      WINDOW w AS (PARTITION BY event_type, chunk, raw_period, measure ORDER BY load)),
x AS (SELECT *, lead(load) OVER (PARTITION BY event_type, chunk, raw_period, measure ORDER BY load) AS later
      FROM n WHERE earlier IS NULL OR raws IS DISTINCT FROM before)
SELECT 'energy' AS source, event_type AS indicator, 'chunk_' || CAST(chunk AS VARCHAR) AS region, raw_period, measure,
       COALESCE(array_to_string(raws, '|'), '') AS raws, make_timestamp(2024, load, 1, 0, 0, 0) AS valid_from,
       make_timestamp(2024, later, 1, 0, 0, 0) AS valid_to
FROM x WHERE later IS NOT NULL
""")
def energy_history(spark, base):
    """The older versions of the revised observations, and the times in which they held."""
    found = revised(_repulled(spark, base))
    return found.withColumn("raw_values", F.array_join("raw_values", "|")).withColumnRenamed("raw_values", "raws")


# ── M1 + M2: delimited text with decimal commas -> Bronze -> Silver ──────

IPI_COLUMNS = ["Comunidades y Ciudades Autónomas", "Indicador", "Periodo", "Total"]


@query("ipi_tidy", f"""
SELECT 'ipi' AS source, 'status_' || o_orderstatus AS indicator, o_orderpriority AS region,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS period, 'index' AS measure,
       {_exact_mean("CAST(o_totalprice AS DECIMAL(18,4))")} AS value
FROM orders GROUP BY ALL
""")
def ipi_tidy(spark, base):
    """``orders`` landed as the statistics-office text layout (``;``,
    ``YYYYMmm`` periods, decimal commas), loaded to Bronze and typed into the
    tidy contract, then averaged per month (an index doesn't add up)."""
    bronze, _overlong = bronze_delimited(spark, land_orders(spark, base), run_stamp())
    return series.monthly(tidy_rows(silver_delimited(bronze, "ipi", *IPI_COLUMNS, measure="index")))


def land_orders(spark, base, value=None, period=None):
    """``orders`` as statistics-office text; ``value`` and ``period`` replace the texts of these columns."""
    text = tables(spark, base).orders.select(
        F.col("o_orderpriority").alias(IPI_COLUMNS[0]),
        F.concat(F.lit("status_"), "o_orderstatus").alias(IPI_COLUMNS[1]),
        (F.date_format("o_orderdate", "yyyy'M'MM") if period is None else period).alias(IPI_COLUMNS[2]),
        (F.regexp_replace(float_text("o_totalprice"), r"\.", ",") if value is None else value).alias(IPI_COLUMNS[3]))
    return write_delimited(text, scratch_path(spark, "ipi_landing"))


# ── P10: unreadable periods and numbers are rejected, blanks counted ─────

@query("period_rejects", """
WITH d AS (SELECT *, o_orderkey % 7 AS k FROM orders),
t AS (SELECT CASE WHEN k = 1 THEN year(o_orderdate) || 'M13' WHEN k = 2 THEN 'n/d'
                  ELSE strftime(o_orderdate, '%YM%m') END AS raw_period,
             CASE WHEN k = 3 THEN '1234.56' WHEN k = 4 THEN '' WHEN k = 5 THEN '1.234,56' WHEN k = 2 THEN 'x,y'
                  ELSE '12,5' END AS raw_value, k, o_orderstatus, o_orderpriority FROM d)
SELECT 'ok' AS status, '' AS "column", '' AS raw, count(*) AS n,
       CAST(sum(CASE WHEN k = 5 THEN 1234.56 ELSE 12.5 END) AS DECIMAL(38,4)) AS total FROM t WHERE k IN (0, 5, 6)
UNION ALL SELECT 'blank', '', '', count(*), NULL FROM t WHERE k = 4
UNION ALL SELECT 'reject', 'period', raw_period, count(*), NULL FROM t WHERE k IN (1, 2) GROUP BY raw_period
UNION ALL SELECT 'reject', 'value', raw_value, count(*), NULL FROM t WHERE k IN (2, 3) GROUP BY raw_value
""")
def period_rejects(spark, base):
    """``orders`` landed with months of 13, words for months, a decimal point where commas are due, and blanks:
    what Silver accepts, finds blank and rejects (a row per failed text)."""
    k = F.col("o_orderkey") % 7
    period = (F.when(k == 1, F.concat(F.year("o_orderdate").cast("string"), F.lit("M13")))
              .when(k == 2, F.lit("n/d")).otherwise(F.date_format("o_orderdate", "yyyy'M'MM")))
    value = (F.when(k == 3, F.lit("1234.56")).when(k == 4, F.lit("")).when(k == 5, F.lit("1.234,56"))
             .when(k == 2, F.lit("x,y")).otherwise(F.lit("12,5")))
    bronze, _overlong = bronze_delimited(spark, land_orders(spark, base, value, period), run_stamp())
    seen = materialize(silver_delimited(bronze, "ipi", *IPI_COLUMNS), "period_rejects")
    empty = F.lit("")
    counted = seen.where("status <> 'reject'").groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("status") == "ok", F.col("value"))).cast(
            "decimal(38,4)").alias("total")).select("status", empty.alias("column"), empty.alias("raw"), "n", "total")
    rejected = reject_rows(seen).groupBy("column", "raw").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("reject").alias("status"), "column", "raw", "n", F.lit(None).cast("decimal(38,4)").alias("total"))
    return counted.unionByName(rejected)


# ── S1/P8: ragged rows and files with headers of their own ───────────────

@query("csv_ragged", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 5 = 1 THEN '' ELSE c_mktsegment END
       AS c_mktsegment, NULL AS record FROM customer WHERE c_custkey % 5 IN (0, 1, 2)
UNION ALL SELECT '', '', '', CAST(c_custkey AS VARCHAR) || ';' || c_name || ';' || c_mktsegment || ';' ||
       CASE WHEN c_custkey % 5 = 3 THEN '' ELSE ';lost' END FROM customer WHERE c_custkey % 5 IN (3, 4)
""")
def csv_ragged(spark, base):
    """``customer`` landed with short rows and rows with surplus fields, an empty one first: short rows are padded,
    overlong ones come back as their whole record."""
    c, k = tables(spark, base).customer, F.col("c_custkey") % 5
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name",
                       F.when(k == 1, F.lit(None)).otherwise(F.col("c_mktsegment")),
                       F.when(k == 3, F.lit("")), F.when(k == 4, F.lit("")), F.when(k == 4, F.lit("lost")))
    landing = scratch_path(spark, "csv_ragged")
    lines = c.select(line.alias("value"))
    names = ["c_custkey", "c_name", "c_mktsegment"]
    lines.write.text(landing)
    read = parse_records(spark.read.text(landing).select(
        F.col("value").alias("record"), F.col("_metadata.file_path").alias("_source_path")), [names], ";")
    good = well_formed(read).select(*names, F.lit(None).cast("string").alias("record"))
    bad = overlong_rows(read).select(*[F.lit("").alias(n) for n in names], F.col(RECORD_COL).alias("record"))
    return good.unionByName(bad)


@query("csv_two_orders", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS c_nationkey FROM customer
""")
def csv_two_orders(spark, base):
    """``customer`` landed in one folder under two headers: other column order, and a column that one half lacks."""
    c, root = all_strings(tables(spark, base).customer), scratch_path(spark, "csv_two_orders")
    odd = F.col("c_custkey").cast("bigint") % 2 == 1
    write_delimited(c.where(~odd).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), f"{root}/a")
    write_delimited(c.where(odd).select("c_mktsegment", "c_custkey", "c_name"), f"{root}/b")
    read = well_formed(read_delimited_files(spark, f"{root}/*"))
    return read.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


@query("csv_multiline", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || chr(10) || 'said "' || o_orderpriority || '";' || chr(10)
            WHEN o_orderkey % 3 = 1 THEN o_orderpriority ELSE chr(10) || chr(10) END AS note,
       CAST(o_custkey AS VARCHAR) AS o_custkey
FROM orders
""")
def csv_multiline(spark, base):
    """``orders`` landed with line breaks, separators and quotes inside quoted fields; blocks are cut at record ends."""
    o, k = tables(spark, base).orders, F.col("o_orderkey") % 3
    note = (F.when(k == 0, F.concat("o_orderstatus", F.lit('\nsaid "'), "o_orderpriority", F.lit('";\n')))
            .when(k == 1, F.col("o_orderpriority")).otherwise(F.lit("\n\n")))
    text = o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), note.alias("note"),
                    F.col("o_custkey").cast("string").alias("o_custkey"))
    landing = write_delimited(text, scratch_path(spark, "csv_multiline"))
    return well_formed(read_delimited(spark, landing, multiline=True)).drop("_source_path")


# ── M4: a whole run, rows and sums of every layer ────────────────────────

_ENERGY = "SELECT event_id, event_type, event_id // 50 AS chunk, date_trunc('month', ts) AS m"


@query("medallion_totals", f"""
WITH e AS ({_ENERGY}, 'value' AS measure, CAST(value AS DECIMAL(18,4)) AS v FROM events UNION ALL
           {_ENERGY}, 'percentage', CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DECIMAL(18,4)) FROM events),
o AS (SELECT o_orderstatus, o_orderpriority, date_trunc('month', o_orderdate) AS m,
             CAST(o_totalprice AS DECIMAL(18,4)) AS v FROM orders)
SELECT 'ipi' AS source, 'landed' AS layer, count(*) AS rows, CAST(NULL AS DECIMAL(38,4)) AS total FROM o
UNION ALL SELECT 'ipi', 'quarantine', 0, NULL
UNION ALL SELECT 'ipi', 'silver_ok', count(v), CAST(sum(v) AS DECIMAL(38,4)) FROM o
UNION ALL SELECT 'ipi', 'silver_blank', count(*) - count(v), NULL FROM o
UNION ALL SELECT 'ipi', 'silver_reject', 0, NULL
UNION ALL SELECT 'ipi', 'silver_rounded', 0, NULL
UNION ALL SELECT 'ipi', 'fact', (SELECT count(*) FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, m FROM o)),
                 (SELECT CAST(sum(v) AS DECIMAL(38,4)) FROM (SELECT {_exact_mean("v")} AS v FROM o
                  GROUP BY o_orderstatus, o_orderpriority, m))
UNION ALL SELECT 'energy', 'landed', count(*), NULL FROM e
UNION ALL SELECT 'energy', 'silver_ok', count(v), CAST(sum(v) AS DECIMAL(38,4)) FROM e
UNION ALL SELECT 'energy', 'silver_blank', count(*) - count(v), NULL FROM e
UNION ALL SELECT 'energy', 'silver_reject', 0, NULL
UNION ALL SELECT 'energy', 'silver_rounded', 0, NULL
UNION ALL SELECT 'energy', 'fact',
                 (SELECT count(*) FROM (SELECT DISTINCT event_type, chunk, m, measure FROM e WHERE v IS NOT NULL)),
                 (SELECT CAST(sum(v) AS DECIMAL(38,4)) FROM (
                    SELECT CASE WHEN measure = 'value' THEN SUM(v) ELSE {_exact_mean("v")} END AS v FROM e
                    WHERE v IS NOT NULL GROUP BY event_type, chunk, m, measure))
""")
def medallion_totals(spark, base):
    """The whole run on ``orders`` (delimited text) and ``events`` (JSON documents): its accounting table."""
    return medallion(spark, base)["accounting"]


def medallion(spark, base):
    """A run of both sources into a lake of its own."""
    payloads, root = scratch_path(spark, "energy_landing"), scratch_path(spark, "lake")
    _landed_documents(tables(spark, base)).write.parquet(payloads)
    return run_medallion(spark, RunConfig(
        lake=f"{root}/lake", log=f"{root}/log", energy_payloads=payloads,
        delimited={"ipi": {"landing": land_orders(spark, base), "region_col": IPI_COLUMNS[0],
                           "indicator_col": IPI_COLUMNS[1], "period_col": IPI_COLUMNS[2],
                           "value_col": IPI_COLUMNS[3]}}))


# ── J6: the unknown members keep facts in the star ───────────────────────

@query("star_unknown", """
WITH m AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS region,
                  CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST(o_totalprice AS DECIMAL(18,4)) AS v
           FROM orders)
SELECT CASE WHEN region IS NULL OR region = '5-LOW' THEN 'UNKNOWN' ELSE region END AS region,
       CASE WHEN year(period) = 1996 THEN NULL ELSE period END AS period, CAST(sum(v) AS DECIMAL(18,4)) AS value
FROM m GROUP BY 1, 2
""")
def star_unknown(spark, base):
    """Facts with a NULL region, with one that the dimension lacks, or in a year that the calendar lacks resolve to the
    unknown members, and the star query keeps them."""
    region = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
    rows = tidy(tables(spark, base).orders, "orders", "order_value", region, F.col("o_orderdate"), "total_price",
                F.col("o_totalprice"))
    monthly = materialize(series.monthly(rows), "star_unknown")
    known = monthly.where("region <> '5-LOW'").select("region")
    dims = build_dims(monthly, known)
    dims["dim_calendar"] = dims["dim_calendar"].where("year <> 1996")
    dims = materialize_all(dims)
    star = Star(keyed_fact(monthly, dims), *[with_unknown(dims[f"dim_{n}"], f"{n}_key") for n in (
        "region", "calendar", "source", "indicator", "measure")])
    return star_by_region_month(star, "orders", "total_price")


# ── M3: derived measures over the consolidated fact ──────────────────────

# exact decimal mean, half up at scale 8 and then 4, as a decimal average is cast
_MEAN = "CAST(ROUND(CAST(sum_{n} AS DECIMAL(38,8)) * 10000 / n_{n}) / 10000 AS DECIMAL(18,4))"
_CHANGE = "ROUND(CAST(value AS DOUBLE) / NULLIF(CAST({p} AS DOUBLE), 0) - 1, 6)"


@query("derived_measures", f"""
WITH m AS ({ORDERS_BY_REGION_SQL} UNION ALL {LINEITEM_BY_REGION_SQL} UNION ALL {EVENTS_BY_TYPE_SQL}),
w AS (
  SELECT *, year(period) * 12 + month(period) AS midx FROM m),
x AS (
  SELECT source, indicator, region, measure, period, value,
    first_value(value) OVER (PARTITION BY source, indicator, region, measure ORDER BY midx
                             RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS p12,
    first_value(value) OVER (PARTITION BY source, indicator, region, measure ORDER BY midx
                             RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS p1,
    SUM(value) OVER y AS sum_y, COUNT(value) OVER y AS n_y, SUM(value) OVER q AS sum_q, COUNT(value) OVER q AS n_q
  FROM w
  WINDOW y AS (PARTITION BY source, indicator, region, measure, year(period) ORDER BY midx
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         q AS (PARTITION BY source, indicator, region, measure, year(period), quarter(period) ORDER BY midx
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT source, indicator, region, measure, period, value,
       {_CHANGE.format(p="p12")} AS yoy, {_CHANGE.format(p="p1")} AS mom,
       CASE WHEN measure = 'value' THEN {_MEAN.format(n="y")} ELSE CAST(sum_y AS DECIMAL(18,4)) END AS ytd,
       CASE WHEN measure = 'value' THEN {_MEAN.format(n="q")} ELSE CAST(sum_q AS DECIMAL(18,4)) END AS qtd
FROM x
""")
def derived_measures(spark, base):
    t = tables(spark, base)
    monthly = consolidate([series.orders_by_region(t), series.lineitem_by_region(t), series.events_by_type(t)])
    monthly = materialize(monthly, "derived_monthly")
    dims = build_dims(monthly, monthly.select("region"), measures={"value": ("count", False)})
    return derive_measures(monthly, materialize(dims["dim_measure"], "dim_measure"))


# ── M3: measures of changed months only ──────────────────────────────────

@query("measures_incremental", REGISTRY["derived_measures"][1])
def measures_incremental(spark, base):
    """Measures built while March 1995 was provisional and the last two months of each series were missing, then
    brought up to date by these months alone."""
    t = tables(spark, base)
    monthly = materialize(consolidate([series.orders_by_region(t), series.lineitem_by_region(t),
                                       series.events_by_type(t)]), "increments_monthly")
    dims = build_dims(monthly, monthly.select("region"), measures={"value": ("count", False)})
    flags = materialize(dims["dim_measure"], "dim_measure")
    last = monthly.groupBy(*increments.SERIES).agg(F.add_months(F.max("period"), -1).alias("end"))
    late = monthly.join(last, increments.SERIES).withColumn("late", F.col("period") >= F.col("end"))
    provisional = F.col("period") == F.lit("1995-03-01").cast("date")
    early = late.where("NOT late").withColumn("value", F.when(provisional, (F.col("value") * 2).cast(
        "decimal(18,4)")).otherwise(F.col("value")))
    roots = [scratch_path(spark, name) for name in ("increments-monthly", "increments-measures")]
    increments.build(early.select(*monthly.columns), flags, *roots)
    increments.apply_changes(late.where(F.col("late") | provisional).select(*monthly.columns), flags, *roots)
    return versions.read(spark, roots[1]).drop("year")
