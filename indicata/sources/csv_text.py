"""S1 — delimited text landed as an all-string Bronze table.

Semantics kept from the single-process loader: ``;`` separator, UTF-8 with
BOM, a header row naming the columns, no type inference and nothing read as
NULL — ``NA`` and ``null`` stay text, a missing value is ``''``.

How this goes with Spark:

* lines, or records with quoted line breaks, are read as they are and taken
  apart by ``from_csv``; the raw record stays at hand;
* empty and quoted-empty fields come back NULL -> ``coalesce(c, '')``;
* doubled quotes need ``escape='"'``; quoted newlines need ``multiline``
  (``csv_records``: one file is still read by many tasks);
* a row longer than the header would be cut silently, an open quote would
  swallow the rest of its line -> such rows come with their whole raw record
  (``_record``) and are quarantined.  Short rows are padded with ``''``;
* repeated header names become ``Total, Total.1`` (pandas style) because the
  names are built from the header line itself, and the BOM is removed from it;
* files of one folder may differ in their header: each row is taken apart by
  the header of its file, in one scan.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.text import file_name
from indicata.sources.csv_records import records

RECORD_COL = "_record"
BOM = "﻿"


def header_names(header_line: str, sep: str = ";") -> list[str]:
    """Column names from a header line, duplicates renamed ``name.1``, ``name.2``."""
    line = header_line.lstrip(BOM).rstrip("\r\n")
    fields = next(csv.reader(io.StringIO(line), delimiter=sep, quotechar='"', doublequote=True))
    seen: dict[str, int] = {}
    names = []
    for f in fields:
        name = f
        if name in seen:
            seen[name] += 1
            name = f"{f}.{seen[f]}"
            while name in seen:
                seen[f] += 1
                name = f"{f}.{seen[f]}"
        seen.setdefault(name, 0)
        names.append(name)
    return names


def _lines(spark: SparkSession, path: str | list[str], encoding: str, header: bool) -> DataFrame:
    """``record, _source_path``: non-empty lines as they are (neither fields nor
    quotes are looked at); with ``header``, without the first one of each file."""
    whole = (spark.read.option("sep", "\x01").option("quote", "").option("header", header)
             .option("encoding", encoding).option("maxCharsPerColumn", -1).option("columnPruning", False)
             .option("columnNameOfCorruptRecord", "_cut").schema("record string, _cut string").csv(path))
    return whole.select(F.coalesce("_cut", "record").alias("record"), F.col("_metadata.file_path").alias("_source_path"),
                        F.col("_metadata.file_block_start").alias("_start")).where(F.col("record").isNotNull())


def files_by_header(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> dict[str, list[str]]:
    """Header line -> files that start with it.

    Only the head of each split is read: a split is a task of its own, which
    stops after its first batch of lines.  As little as one row per file
    reaches the driver (as the file listing does)."""
    alone = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(alone)

    def head(batches):
        for batch in batches:
            if batch.num_rows and batch.column("_start")[0].as_py() == 0:
                yield batch.slice(0, 1)
            return

    spark.conf.set(alone, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        lines = _lines(spark, path, encoding, header=False)
        heads = lines.mapInArrow(head, "record string, _source_path string, _start bigint").collect()
    finally:
        spark.conf.set(alone, before)
    groups: dict[str, list[str]] = {}
    for row in heads:
        groups.setdefault(row.record.lstrip(BOM), []).append(row._source_path)
    return groups


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (RECORD_COL, "_source_path")]


def parse_records(records: DataFrame, layouts: list[list[str]], sep: str, layout: Column | None = None) -> DataFrame:
    """Fields of raw records (``record, _source_path``) by name: the names of
    all layouts in the order in which they first occur (``''`` where a record
    lacks one), ``_record`` (the whole raw record of a row with more fields than
    its layout, or with a quoted field that never closes, else NULL) and
    ``_source_path``.  ``layout``: the number of each record's layout."""
    names = list(dict.fromkeys(n for x in layouts for n in x))
    layout = F.lit(0) if layout is None else layout
    width = max(len(x) for x in layouts)
    fields = F.from_csv("record", ", ".join(f"f{i} string" for i in range(max(width, 2))), {
        "sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    # quoted fields taken out (a quote opens one at its first place only); what still opens one never closes
    cut = f"\\Q{sep}\\E"
    bare = F.when(F.contains("record", F.lit('"')), F.regexp_replace(
        "record", f'(^|{cut})"[^"]*+(?:""[^"]*+)*+"', "$1")).otherwise(F.col("record"))
    own = F.lit(len(layouts[0]))
    for i, x in enumerate(layouts[1:], 1):
        own = F.when(layout == i, len(x)).otherwise(own)
    rows = records.select("record", "_source_path", layout.alias("layout"), fields.alias("fields"), bare.alias("bare"))
    count = F.length("bare") - F.length(F.replace(F.col("bare"), F.lit(sep), F.lit(""))) + 1
    bad = (count > own) | F.col("bare").rlike(f'(^|{cut})"')

    def value(name: str) -> Column:
        places = {i: x.index(name) for i, x in enumerate(layouts) if name in x}
        found = F.lit(None).cast("string")
        for place in sorted(set(places.values())):
            here = [i for i, p in places.items() if p == place]
            field = F.col(f"fields.f{place}")
            found = field if len(here) == len(layouts) else F.when(F.col("layout").isin(here), field).otherwise(found)
        return F.coalesce(found, F.lit(""))

    return rows.select(*[value(n).alias(n) for n in names], F.when(bad, F.col("record")).alias(RECORD_COL),
                       "_source_path")


def _read(spark: SparkSession, path: str | list[str], sep: str, encoding: str, multiline: bool,
          groups: list[tuple[list[str], list[str]]]) -> DataFrame:
    """Files of several layouts (names, files) in one scan; which layout a file has is joined to its rows (a row per
    file, which the planner broadcasts by size)."""
    rows = None
    if multiline:
        if encoding.upper().replace("-", "") == "UTF8":
            rows = records(spark, path, sep)
        if rows is None:
            raise ValueError("quoted line breaks need UTF-8 text whose blocks mostly start outside of quotes")
        rows = rows.where(~F.col("first")).select("record", "_source_path")
    else:
        rows = _lines(spark, path, encoding, header=True)
    layouts = [names for names, _ in groups]
    if len(layouts) == 1:
        return parse_records(rows, layouts, sep)
    files = spark.createDataFrame([(f, i) for i, (_, own) in enumerate(groups) for f in own],
                                  "_source_path string, layout int")
    return parse_records(rows.join(files, "_source_path"), layouts, sep, F.col("layout"))


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "UTF-8",
                   multiline: bool = False) -> DataFrame:
    """All-string frame of files that share one header (else the call fails; see
    ``read_delimited_files``): header columns (``''`` for missing), ``_record``
    (the whole raw record of a row with more fields than the header, or with an
    open quote, else NULL) and ``_source_path`` (full file path).

    ``multiline`` allows quoted line breaks (see ``csv_records``); without it a
    record is a line, and one whose quote stays open is not cut silently but
    kept whole in ``_record``."""
    groups = files_by_header(spark, path, encoding)
    if len(groups) != 1:
        raise ValueError(f"files of {len(groups)} headers under {path}: {sorted(groups)[:3]}" if groups
                         else f"no data under {path}")
    (line, files), = groups.items()
    return _read(spark, path, sep, encoding, multiline, [(header_names(line, sep), files)])


def read_delimited_files(spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "UTF-8",
                         multiline: bool = False) -> DataFrame:
    """``read_delimited`` for a landing folder whose files have headers of
    their own: values go by column name, in the order in which names first
    occur; a column that a file lacks is ``''``."""
    groups = sorted(files_by_header(spark, path, encoding).items(), key=lambda x: min(x[1]))
    if not groups:
        raise ValueError(f"no data under {path}")
    return _read(spark, path, sep, encoding, multiline, [(header_names(line, sep), files) for line, files in groups])


def overlong_rows(df: DataFrame) -> DataFrame:
    """Rows with more fields than the header or an open quote, as landed (quarantine)."""
    return df.where(F.col(RECORD_COL).isNotNull()).select(RECORD_COL, "_source_path")


def well_formed(df: DataFrame) -> DataFrame:
    return df.where(F.col(RECORD_COL).isNull()).drop(RECORD_COL)


def bronze_from_delimited(df: DataFrame, run_ts: str | Column) -> DataFrame:
    """Bronze lineage on a ``read_delimited`` frame: ``_ingestion_timestamp``
    (one stamp per run) and ``_source_file`` (file name)."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    data = data_columns(df)
    return df.select(*[F.col(f"`{c}`") for c in data], ts.alias("_ingestion_timestamp"),
                     file_name(F.col("_source_path")).alias("_source_file"))


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> str:
    """Write an all-string frame as delimited text with a header line; blanks
    at the ends of values stay."""
    (df.write.mode("overwrite").option("sep", sep).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').csv(path))
    return path
