"""S2/R1 — JSON series documents landed as one row per request.

Landed payload table: ``request columns…, body string``.  The body is
``{"included": [{"type": …, "attributes": {"values": [{"datetime", "value",
"percentage"}…]}}…]}``.  Parsing is strict on the structure (``included``,
``type``, ``attributes.values``: a document without them fails the job, as a
``KeyError`` would) and lenient on the three leaf fields (absent -> NULL).
A series with an empty ``values`` list yields no rows.

Numbers are read *as their JSON token text*, then rendered the way Python
prints the parsed value: an integer token stays an integer, any other token
becomes float text (``1.50e3`` -> ``1500.0``).  The text therefore depends
only on the value itself, never on what else was loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions.text import json_number_text

POINT = T.StructType([
    T.StructField("datetime", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("percentage", T.StringType()),
])
SERIES = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("attributes", T.StructType([T.StructField("values", T.ArrayType(POINT))])),
])
DOCUMENT = T.StructType([T.StructField("included", T.ArrayType(SERIES))])


def parse_documents(payloads: DataFrame, body: str = "body", context: list[str] | None = None,
                    strict: bool = True) -> DataFrame:
    """Flatten documents to ``context…, series_type, datetime, value,
    percentage`` (all strings).

    ``strict=False`` leaves malformed documents out instead of failing.
    """
    context = context or []
    # The strictness check references the parsed document several times in
    # one projection; Spark's subexpression elimination evaluates it once.
    doc = F.from_json(F.col(body), DOCUMENT)
    if strict:
        bad = doc.isNull() | doc["included"].isNull()
        doc = F.when(bad, F.raise_error(F.concat(
            F.lit("malformed document: "), F.substring(F.col(body), 1, 200)))).otherwise(doc)
    parsed = payloads.select(*context, doc.alias("_doc"))
    if not strict:
        parsed = parsed.where(F.col("_doc.included").isNotNull())
    s = F.col("s")
    if strict:
        missing = s["type"].isNull() | s["attributes"].isNull() | s["attributes"]["values"].isNull()
        s = F.when(missing, F.raise_error(F.lit("series without type or attributes.values"))).otherwise(s)
    series = parsed.select(*context, F.explode("_doc.included").alias("s")).select(*context, s.alias("s"))
    # the type is taken out first: a point that is exploded with its series carries all points of it along
    series = series.select(*context, F.col("s.type").alias("series_type"), F.col("s.attributes.values").alias("points"))
    points = series.select(*context, "series_type", F.explode("points").alias("p"))
    return points.select(*context, "series_type", F.col("p.datetime").alias("datetime"),
                         json_number_text("p.value").alias("value"),
                         json_number_text("p.percentage").alias("percentage"))



def energy_bronze(points: DataFrame, run_ts: str, api_path: str,
                  geo_col: str = "geo_name") -> DataFrame:
    """Energy Bronze layout, all strings, NULL leaves kept as NULL; the time
    at which a document was loaded (``_loaded_at``) stays where it is known."""
    loaded = ["_loaded_at"] if "_loaded_at" in points.columns else []
    return points.select(
        "series_type", F.col(geo_col).cast("string").alias("geo_name"), "datetime", "value",
        "percentage", F.lit(run_ts).alias("_ingestion_timestamp"), F.lit(api_path).alias("_source_api"), *loaded)
