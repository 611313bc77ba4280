"""Catalog: Bronze — landing scans, lineage, text rules, grids, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicata.functions import (cell_text_legacy, cell_text_xlsx, empty_to_null, float_text,
                                url_last_segment)
from indicata.operators.bronze import add_lineage, all_strings, width_violations
from indicata.plans.catalog import query, tables
from indicata.session import scratch_path
from indicata.sinks.files import read_snapshot, write_snapshot
from indicata.sources.cells import fill_headers, grid_shape, label_cells, to_grid
from indicata.sources.csv_text import read_delimited, write_delimited
from indicata.sources.json_docs import energy_bronze, parse_documents
from indicata.sources.manifest import tag_with_manifest
from indicata.sources.requests import request_grid

RUN_TS = "2024-01-01T00:00:00+00:00"  # fixed stamp: deterministic lineage in checks
API_PATH = "/api/demand"
BASE_URL = "https://api.example/demand"


# ── S1 delimited text ─────────────────────────────────────────────────────

@query("scan_csv_strings", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
""")
def scan_csv_strings(spark, base):
    """Land ``customer`` as ``;`` text, scan it back as all strings."""
    path = scratch_path(spark, "customer_csv")
    write_delimited(all_strings(tables(spark, base).customer), path)
    df = read_delimited(spark, path)
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("landing_stream", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
""")
def landing_stream(spark, base):
    """``customer`` dropped as ``;`` text into a landing folder, picked up by
    the checkpointed ``availableNow`` file stream into a Bronze Parquet table,
    read back (data columns; the stream's stamp and file names vary)."""
    from indicata.streaming.landing import read_landing, start_landing

    landing = scratch_path(spark, "stream_landing")
    write_delimited(all_strings(tables(spark, base).customer), landing)
    target, checkpoint = scratch_path(spark, "stream_bronze"), scratch_path(spark, "stream_checkpoint")
    start_landing(spark, landing, target, checkpoint).awaitTermination()
    return read_landing(spark, target).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("landing_headers", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 3 = 1 THEN '' ELSE c_mktsegment END
       AS c_mktsegment, CASE WHEN c_custkey % 3 = 2 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS c_nationkey
FROM customer
""")
def landing_headers(spark, base):
    """``customer`` dropped under three headers (another column order, a column less, a column more), the last one
    after a restart of the stream: every value under its own column, the new column empty before."""
    from indicata.streaming.landing import read_landing, start_landing

    c, root = all_strings(tables(spark, base).customer), scratch_path(spark, "landing_headers")
    target, checkpoint = scratch_path(spark, "headers_bronze"), scratch_path(spark, "headers_checkpoint")
    layouts = [["c_custkey", "c_name", "c_mktsegment"], ["c_name", "c_custkey"],
               ["c_mktsegment", "c_nationkey", "c_name", "c_custkey"]]
    for i, names in enumerate(layouts):
        part = c.where(F.col("c_custkey").cast("bigint") % 3 == i).select(*names)
        write_delimited(part, f"{root}/part{i}")
        if i:   # the first two arrive together
            start_landing(spark, f"{root}/*", target, checkpoint).awaitTermination()
    return read_landing(spark, target).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


# ── S2/R1 JSON documents ──────────────────────────────────────────────────

POINTS_PER_DOCUMENT = 50


def _landed_documents(t, events=None):
    """Events (or those given) landed as series documents: one document per
    block of 50 consecutive event ids, one series per event type in it."""
    e = (t.events if events is None else events).select(
        (F.col("event_id") / POINTS_PER_DOCUMENT).cast("bigint").alias("block"), "event_type",
        F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                 F.col("value").alias("value"),
                 F.get_json_object("props", "$.k").cast("int").alias("percentage")).alias("point"))
    series = e.groupBy("block", "event_type").agg(F.collect_list("point").alias("values")).select(
        "block", F.struct(F.col("event_type").alias("type"),
                          F.struct(F.col("values").alias("values")).alias("attributes")).alias("s"))
    docs = series.groupBy("block").agg(F.collect_list("s").alias("included"))
    return docs.select(F.concat(F.lit("chunk_"), F.col("block").cast("string")).alias("geo_name"),
                       F.to_json(F.struct("included")).alias("body"))


@query("json_series_points", f"""
SELECT event_type AS series_type, 'chunk_' || CAST(event_id // {POINTS_PER_DOCUMENT} AS VARCHAR) AS geo_name,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime, CAST(value AS VARCHAR) AS value,
       CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) AS percentage,
       '{RUN_TS}' AS _ingestion_timestamp, '{API_PATH}' AS _source_api
FROM events
""")
def json_series_points(spark, base):
    points = parse_documents(_landed_documents(tables(spark, base)), context=["geo_name"])
    return energy_bronze(points, RUN_TS, API_PATH)


# ── S6 manifest ──────────────────────────────────────────────────────────

def _manifest(spark):
    i = F.col("id")
    return spark.range(20).select(
        F.concat(F.lit("src"), i.cast("string")).alias("file_id"),
        F.when(i % 2 == 0, F.lit("estado")).otherwise(F.lit("entes")).alias("agent"),
        (i >= 10).alias("is_continuation"), (F.lit(1) + i % 3).cast("int").alias("header_rows"))


@query("manifest_tag", """
WITH m AS (SELECT 'src' || CAST(i AS VARCHAR) AS file_id,
                  CASE WHEN i % 2 = 0 THEN 'estado' ELSE 'entes' END AS agent,
                  i >= 10 AS is_continuation, CAST(1 + i % 3 AS INTEGER) AS header_rows
           FROM range(20) t(i))
SELECT d.doc_id, d.source, m.agent, m.is_continuation, m.header_rows
FROM documents d JOIN m ON d.source = m.file_id
""")
def manifest_tag(spark, base):
    docs = tables(spark, base).documents.select("doc_id", "source")
    return tag_with_manifest(docs, _manifest(spark), "source")


# ── S7 request grid ──────────────────────────────────────────────────────

@query("request_grid", f"""
WITH b AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
g AS (SELECT r_name AS geo_name, r_regionkey AS geo_id,
             CASE WHEN r_regionkey = 0 THEN 'peninsular' ELSE 'ccaa' END AS geo_limit,
             CAST(unnest(generate_series((SELECT lo FROM b), (SELECT hi FROM b))) AS INTEGER) AS year
      FROM region)
SELECT geo_name, geo_id, geo_limit, year,
       '{BASE_URL}?start_date=' || year || '-01-01T00:00&end_date=' || year
       || '-12-31T23:59&time_trunc=month&geo_trunc=electric_system&geo_limit=' || geo_limit
       || '&geo_ids=' || geo_id AS url
FROM g
""")
def request_grid_q(spark, base):
    t = tables(spark, base)
    years = t.orders.select(F.year("o_orderdate").alias("y"))
    regions = t.region.select(
        F.col("r_name").alias("geo_name"), F.col("r_regionkey").alias("geo_id"),
        F.when(F.col("r_regionkey") == 0, F.lit("peninsular")).otherwise(F.lit("ccaa")).alias("geo_limit"))
    return request_grid(regions, years.select(F.min("y")).scalar(), years.select(F.max("y")).scalar(),
                        BASE_URL)


# ── S5 / A3 / R3 cell grids ──────────────────────────────────────────────

CUSTOMER_CELLS_SQL = """
  SELECT 'part_' || CAST(c_custkey % 4 AS VARCHAR) AS file, 'Sheet1' AS sheet,
         CAST(c_custkey // 4 + 1 + c_custkey // 40 AS INTEGER) AS row_idx, *
  FROM customer
"""


def _customer_cells(t):
    """Customers as sheet cells: four files, one row per customer, and after
    every ten rows of a file one blank row (a gap in the numbering).  Column
    6 holds a flag only for one market segment, so most of its cells are
    blank.  Every customer value is in the grid; the grid restores blanks."""
    texts = all_strings(t.customer.withColumn("_k", F.col("c_custkey")), keep=("_k",))
    k = F.col("_k")
    cells = texts.select(
        F.concat(F.lit("part_"), (k % 4).cast("string")).alias("file"),
        F.lit("Sheet1").alias("sheet"),
        (F.floor(k / 4) + 1 + F.floor(k / 40)).cast("int").alias("row_idx"),
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("col_idx"), v.alias("text")) for i, v in enumerate([
                F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey"), F.col("c_acctbal"),
                F.col("c_mktsegment"),
                F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("auto"))], 1)])).alias("cell"))
    return (cells.where(F.col("cell.text").isNotNull())
            .select("file", "sheet", "row_idx", "cell.col_idx", "cell.text"))


@query("grid_from_cells", f"""
WITH c AS ({CUSTOMER_CELLS_SQL}),
m AS (SELECT file, sheet, max(row_idx) AS n FROM c GROUP BY file, sheet),
s AS (SELECT file, sheet, CAST(unnest(generate_series(1, n)) AS INTEGER) AS row_idx FROM m)
SELECT s.file, s.sheet, s.row_idx,
       COALESCE(CAST(c.c_custkey AS VARCHAR), '') AS col_01,
       COALESCE(c.c_name, '') AS col_02,
       COALESCE(CAST(c.c_nationkey AS VARCHAR), '') AS col_03,
       COALESCE(CAST(c.c_acctbal AS VARCHAR), '') AS col_04,
       COALESCE(c.c_mktsegment, '') AS col_05,
       CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'auto' ELSE '' END AS col_06
FROM s LEFT JOIN c ON s.file = c.file AND s.sheet = c.sheet AND s.row_idx = c.row_idx
""")
def grid_from_cells(spark, base):
    return to_grid(_customer_cells(tables(spark, base)), width=6)


@query("grid_shape", f"""
WITH c AS ({CUSTOMER_CELLS_SQL})
SELECT file, sheet, max(row_idx) AS n_rows,
       CASE WHEN count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') > 0 THEN 6 ELSE 5 END AS n_cols,
       count(*) * 5 + count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS n_cells
FROM c GROUP BY file, sheet
""")
def grid_shape_q(spark, base):
    return grid_shape(_customer_cells(tables(spark, base)))


@query("header_fill", """
WITH o AS (SELECT CAST(o_orderkey // 8 + 1 AS INTEGER) AS row_idx, CAST(o_orderkey % 8 + 1 AS INTEGER) AS col_idx,
                  o_orderpriority FROM orders),
c AS (SELECT o.row_idx, o.col_idx,
             CASE WHEN o.o_orderpriority = p.o_orderpriority THEN '' ELSE o.o_orderpriority END AS text
      FROM o LEFT JOIN o p ON p.row_idx = o.row_idx AND p.col_idx = o.col_idx - 1)
SELECT 'orders' AS file, 'Sheet1' AS sheet, row_idx, col_idx, text,
       last_value(NULLIF(text, '') IGNORE NULLS) OVER (PARTITION BY row_idx ORDER BY col_idx
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
FROM c
""")
def header_fill(spark, base):
    """Header rows with merged cells: ``orders`` laid out eight to a row,
    each cell's priority kept only where it differs from its left neighbour
    (a merged run keeps its value in the first cell only).  Filling forward
    along the row restores every priority."""
    o = tables(spark, base).orders
    pos = o.select((F.floor(F.col("o_orderkey") / 8) + 1).cast("int").alias("row_idx"),
                   (F.col("o_orderkey") % 8 + 1).cast("int").alias("col_idx"), "o_orderpriority")
    left = pos.select("row_idx", (F.col("col_idx") + 1).alias("col_idx"),
                      F.col("o_orderpriority").alias("_left"))
    cells = pos.join(left, ["row_idx", "col_idx"], "left").select(
        F.lit("orders").alias("file"), F.lit("Sheet1").alias("sheet"), "row_idx", "col_idx",
        F.when(F.col("o_orderpriority") == F.col("_left"), F.lit("")).otherwise(F.col("o_orderpriority"))
        .alias("text"))
    return fill_headers(cells)


@query("header_labels", """
WITH o AS (SELECT 'f' || CAST(o_orderkey % 3 AS VARCHAR) AS file, CAST(o_orderkey // 3 + 1 AS INTEGER) AS row_idx, *
           FROM orders),
c AS (SELECT file, row_idx, 1 AS col_idx, o_orderpriority AS text FROM o
      UNION ALL SELECT file, row_idx, 2, o_orderstatus FROM o
      UNION ALL SELECT file, row_idx, 3, o_orderstatus FROM o WHERE row_idx > 2
      UNION ALL SELECT file, row_idx, 4, CAST(o_totalprice AS VARCHAR) FROM o),
w AS (SELECT file, max(col_idx) AS width FROM c GROUP BY file),
r AS (SELECT file, width, unnest(generate_series(1, 2)) AS row_idx FROM w),
p AS (SELECT file, row_idx, unnest(generate_series(1, width)) AS col_idx FROM r),
h AS (SELECT p.file, p.row_idx, p.col_idx, COALESCE(c.text, '') AS text
      FROM p LEFT JOIN c ON c.file = p.file AND c.row_idx = p.row_idx AND c.col_idx = p.col_idx),
f AS (SELECT file, row_idx, col_idx,
             last_value(NULLIF(text, '') IGNORE NULLS) OVER (PARTITION BY file, row_idx ORDER BY col_idx
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM h),
n AS (SELECT file, col_idx, string_agg(filled, ' / ' ORDER BY row_idx) AS header FROM f GROUP BY file, col_idx)
SELECT c.file, 'Sheet1' AS sheet, c.row_idx, c.col_idx, c.text, n.header
FROM c LEFT JOIN n ON n.file = c.file AND n.col_idx = c.col_idx
WHERE c.row_idx > 2
""")
def header_labels(spark, base):
    """Multi-row headers attached to data cells: ``orders`` laid out as three
    sheets, four columns, two header rows; column 3 repeats column 2, and in
    the header rows it is a merged cell (blank), so its name comes from the
    fill.  Data cells get ``row 1 / row 2`` of their column."""
    o = tables(spark, base).orders
    file = F.concat(F.lit("f"), (F.col("o_orderkey") % 3).cast("string"))
    row = (F.floor(F.col("o_orderkey") / 3) + 1).cast("int")
    cells = o.select(file.alias("file"), F.lit("Sheet1").alias("sheet"), row.alias("row_idx"), F.explode(F.array(
        F.struct(F.lit(1).alias("col_idx"), F.col("o_orderpriority").alias("text")),
        F.struct(F.lit(2).alias("col_idx"), F.col("o_orderstatus").alias("text")),
        F.struct(F.lit(3).alias("col_idx"), F.when(row > 2, F.col("o_orderstatus")).alias("text")),
        F.struct(F.lit(4).alias("col_idx"), float_text("o_totalprice").alias("text")))).alias("c"))
    cells = cells.select("file", "sheet", "row_idx", "c.col_idx", "c.text").where(F.col("text").isNotNull())
    # per-sheet header depth is configuration (as in a manifest), not data
    header_rows = spark.range(3).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"),
                                        F.lit("Sheet1").alias("sheet"), F.lit(2).alias("header_rows"))
    return label_cells(cells, header_rows).select("file", "sheet", "row_idx", "col_idx", "text", "header")


# ── F1–F3, F5 text functions ─────────────────────────────────────────────

@query("float_text", """
SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS price_text FROM part
UNION ALL
SELECT -1 - o_orderkey, CAST(o_totalprice AS VARCHAR) FROM orders
""")
def float_text_q(spark, base):
    t = tables(spark, base)
    return (t.part.select("p_partkey", float_text("p_retailprice").alias("price_text"))
            .unionByName(t.orders.select((F.lit(-1) - F.col("o_orderkey")).alias("p_partkey"),
                                         float_text("o_totalprice").alias("price_text"))))


def _part_cells(t, integral_as_int: bool):
    p = t.part
    price = F.col("p_retailprice")
    raw_price = (F.when(price == F.floor(price), price.cast("decimal(38,0)").cast("string"))
                 .otherwise(float_text(price))) if integral_as_int else float_text(price)
    return p.select("p_partkey", raw_price.alias("price_raw"),
                    F.col("p_size").cast("string").alias("size_raw"),
                    F.when(F.col("p_size") > 25, F.lit("1")).otherwise(F.lit("0")).alias("flag_raw"),
                    (F.lit(45000) + F.col("p_size")).cast("string").alias("date_raw"),
                    "p_brand")


@query("cell_text_legacy", """
SELECT p_partkey,
       CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
            ELSE CAST(p_retailprice AS VARCHAR) END AS price_text,
       CAST(p_size AS VARCHAR) AS size_text,
       CASE WHEN p_size > 25 THEN '1' ELSE '0' END AS flag_text,
       CAST(45000 + p_size AS VARCHAR) AS date_text,
       p_brand AS brand_text
FROM part
""")
def cell_text_legacy_q(spark, base):
    c = _part_cells(tables(spark, base), integral_as_int=False)
    return c.select("p_partkey", cell_text_legacy("price_raw", F.lit("n")).alias("price_text"),
                    cell_text_legacy("size_raw", F.lit("n")).alias("size_text"),
                    cell_text_legacy("flag_raw", F.lit("b")).alias("flag_text"),
                    cell_text_legacy("date_raw", F.lit("d")).alias("date_text"),
                    cell_text_legacy("p_brand", F.lit("s")).alias("brand_text"))


@query("cell_text_xlsx", """
SELECT p_partkey,
       CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
            ELSE CAST(p_retailprice AS VARCHAR) END AS price_text,
       CAST(p_size AS VARCHAR) AS size_text,
       CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS flag_text,
       strftime(DATE '1899-12-30' + CAST(45000 + p_size AS INTEGER), '%Y-%m-%d %H:%M:%S') AS date_text,
       p_brand AS brand_text
FROM part
""")
def cell_text_xlsx_q(spark, base):
    c = _part_cells(tables(spark, base), integral_as_int=True)
    return c.select("p_partkey", cell_text_xlsx("price_raw", F.lit("n")).alias("price_text"),
                    cell_text_xlsx("size_raw", F.lit("n")).alias("size_text"),
                    cell_text_xlsx("flag_raw", F.lit("b")).alias("flag_text"),
                    cell_text_xlsx("date_raw", F.lit("d")).alias("date_text"),
                    cell_text_xlsx("p_brand", F.lit("s")).alias("brand_text"))


@query("path_parts", """
SELECT page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1) AS host,
       regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
       regexp_extract(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1)
         AS last_segment
FROM pages
""")
def path_parts(spark, base):
    p = tables(spark, base).pages
    return p.select("page_id", F.try_parse_url("url", F.lit("HOST")).alias("host"),
                    F.try_parse_url("url", F.lit("PATH")).alias("path"),
                    url_last_segment("url").alias("last_segment"))


# ── K1 snapshot ──────────────────────────────────────────────────────────

@query("snapshot_roundtrip", "SELECT * FROM orders")
def snapshot_roundtrip(spark, base):
    """Write ``orders`` as a snapshot with one output per status (dynamic
    overwrite), read it back."""
    path = scratch_path(spark, "orders_snapshot")
    write_snapshot(tables(spark, base).orders, path, per_file_col="o_orderstatus")
    return read_snapshot(spark, path)


# ── P1, P2, P3, P8 Bronze projections ────────────────────────────────────

@query("bronze_lineage", f"""
SELECT *, '{RUN_TS}' AS _ingestion_timestamp, 'orders.parquet' AS _source_file FROM orders
""")
def bronze_lineage(spark, base):
    return add_lineage(tables(spark, base).orders, RUN_TS)


@query("bronze_all_strings", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
       o_orderpriority
FROM orders
""")
def bronze_all_strings(spark, base):
    return all_strings(tables(spark, base).orders)


@query("empty_to_null", """
SELECT c.conv_id, c.turn, c.role, c.text, NULLIF(COALESCE(n.text, ''), '') AS reply
FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1
""")
def empty_to_null_q(spark, base):
    """Each turn with the text of the reply to it; the last turn of a
    conversation lands with an empty reply, which the staging rule stores as
    NULL.  The reply is found by a key join on (conversation, turn + 1), so a
    very long conversation is never gathered into one task."""
    c = tables(spark, base).conversations
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_reply"))
    landed = c.join(nxt, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", F.coalesce(F.col("_reply"), F.lit("")).alias("reply"))
    return landed.select("conv_id", "turn", "role", "text", empty_to_null("reply").alias("reply"))


@query("width_violations", """
SELECT doc_id, 'text' AS column_name, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE length(text) > 500
UNION ALL
SELECT doc_id, 'lang', CAST(length(lang) AS BIGINT) FROM documents WHERE length(lang) > 500
UNION ALL
SELECT doc_id, 'source', CAST(length(source) AS BIGINT) FROM documents WHERE length(source) > 500
""")
def width_violations_q(spark, base):
    d = tables(spark, base).documents.select("doc_id", "text", "lang", "source")
    return width_violations(d, ["doc_id"], 500)
