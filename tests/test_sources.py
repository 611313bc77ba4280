import os

import pytest
from pyspark.sql import functions as F

from indicata.functions import empty_to_null
from indicata.operators.bronze import width_violations
from indicata.plans.bronze import bronze_delimited, bronze_tax, stage_delimited
from indicata.sources.cells import (fill_headers, grid_shape, label_cells, to_grid, wider_than_header,
                                   with_blank_cells)
from indicata.sources.csv_text import header_names
from indicata.sources.jdbc import read_table, write_staging
from indicata.sources.json_docs import parse_documents
from indicata.sources.manifest import tag_with_manifest
from indicata.sources.requests import fetch_outcome, request_grid
from indicata.sources.workbook import decode_xlsx, read_xlsx_cells, xlsx_text

from tests.fixtures import ipi_csv, tax_workbook

RUN_TS = "2024-05-01T10:00:00+00:00"


def test_header_names_like_pandas():
    assert header_names("﻿A;B;A;A.1;A") == ["A", "B", "A.1", "A.1.1", "A.2"]


def test_delimited_traps(spark, tmp_path):
    path = ipi_csv(str(tmp_path / "landing" / "ipi.csv"))
    bronze, overlong = bronze_delimited(spark, os.path.dirname(path), RUN_TS, multiline=True)
    rows = bronze.collect()
    first = "Comunidades y Ciudades Autónomas"
    assert bronze.columns[:5] == [first, "Indicador", "Periodo", "Total", "Total.1"]
    assert bronze.columns[5:] == ["_ingestion_timestamp", "_source_file"]
    by = {r[first]: r for r in rows}
    assert by["Madrid"]["Indicador"] == 'Índice "general"'
    assert by["Madrid"]["Total.1"] == "NA"                         # NA stays text
    assert by["Cataluña"]["Total"] == "" and by["Cataluña"]["Total.1"] == "null"
    assert by["Cataluña"]["Indicador"].startswith("línea") and "segunda" in by["Cataluña"]["Indicador"]
    assert by["Galicia"]["Periodo"] == "" and by["Galicia"]["Total"] == ""   # short row padded
    assert first in by                                             # repeated header is a data row
    assert all(r["_source_file"] == "ipi.csv" and r["_ingestion_timestamp"] == RUN_TS for r in rows)
    assert len(rows) == 5                                          # blank line skipped, long row quarantined
    assert [r._record.split(";")[0] for r in overlong.collect()] == ["Aragón"]   # the whole record
    assert bronze.where(F.col(first) == "Cataluña").select(empty_to_null("Total").alias("t")).first().t is None
    v = width_violations(bronze, [first], 500).collect()
    assert [(r[first], r.column_name, r.n_chars) for r in v] == [("Murcia", "Indicador", 501)]


PAYLOADS = [
    ("Madrid", 2014, '{"included":[{"type":"Demanda","attributes":{"values":['
     '{"datetime":"2014-01-01T00:00:00.000+01:00","value":22733442.07,"percentage":1},'
     '{"datetime":"2014-02-01T00:00:00.000+01:00","value":5,"percentage":0.5},'
     '{"datetime":"2014-03-01T00:00:00.000+01:00","value":12000000}]}},'
     '{"type":"Vacia","attributes":{"values":[]}}]}'),
]


def test_json_points_text_and_strictness(spark):
    df = spark.createDataFrame(PAYLOADS, "geo_name string, year int, body string")
    got = parse_documents(df, context=["geo_name"]).collect()
    assert [(r.series_type, r.datetime[:10], r.value, r.percentage) for r in got] == [
        ("Demanda", "2014-01-01", "22733442.07", "1"), ("Demanda", "2014-02-01", "5", "0.5"),
        ("Demanda", "2014-03-01", "12000000", None)]
    bad = spark.createDataFrame(PAYLOADS + [("Cat", 2015, '{"x": 1}'), ("Cat", 2016, "not json")],
                                "geo_name string, year int, body string")
    assert parse_documents(bad, context=["geo_name"], strict=False).count() == 3
    with pytest.raises(Exception, match="malformed document"):
        parse_documents(bad, context=["geo_name"]).collect()
    no_type = spark.createDataFrame([("x", 1, '{"included":[{"attributes":{"values":[]}}]}')],
                                    "geo_name string, year int, body string")
    with pytest.raises(Exception, match="series without type"):
        parse_documents(no_type, context=["geo_name"]).collect()


def test_xlsx_decode_and_grid(spark, tmp_path):
    path = tax_workbook(str(tmp_path / "wb" / "tax.xlsx"))
    with open(path, "rb") as f:
        cells = list(decode_xlsx(f.read(), "tax.xlsx", sheet="datos_delegaciones"))
    assert ("tax.xlsx", "datos_delegaciones", 0, 3, 4, "n", "500") in cells  # cached formula value
    with open(path, "rb") as f, pytest.raises(KeyError):
        list(decode_xlsx(f.read(), "tax.xlsx", sheet="missing"))
    bronze = bronze_tax(spark, str(tmp_path / "wb"), RUN_TS).orderBy("_row_number").collect()
    assert [r._row_number for r in bronze] == [1, 2, 3, 4, 5, 6]       # blank row 5 kept
    assert len([c for c in bronze[0].asDict() if c.startswith("col_")]) == 5  # widest row
    r3, r4, r5, r6 = bronze[2], bronze[3], bronze[4], bronze[5]
    assert (r3.col_01, r3.col_02, r3.col_03, r3.col_04, r3.col_05) == ("Madrid", "1500", "2500.5", "500", "")
    assert (r4.col_01, r4.col_02, r4.col_03, r4.col_04) == ("Barcelona", "5.0", "True", "#DIV/0!")
    assert all(getattr(r5, f"col_0{i}") == "" for i in range(1, 6))
    assert (r6.col_02, r6.col_03, r6.col_04, r6.col_05) == ("1e-05", "2024-01-30 12:00:00", "x", "7")
    assert {r._source_file for r in bronze} == {"tax.xlsx"}
    other = read_xlsx_cells(spark, str(tmp_path / "wb"), sheet_index=1).collect()
    assert [(r.sheet, r.row_idx, r.raw) for r in other] == [("otra", 1, "notes"), ("otra", 2, "1")]


def test_header_fill_and_labels(spark, tmp_path):
    tax_workbook(str(tmp_path / "wb" / "tax.xlsx"))
    cells = xlsx_text(read_xlsx_cells(spark, str(tmp_path / "wb"), sheet="datos_delegaciones"))
    hdr = spark.createDataFrame([("tax.xlsx", "datos_delegaciones", 2)], "file string, sheet string, header_rows int")
    filled = fill_headers(with_blank_cells(cells, hdr)).where("row_idx = 1").orderBy("col_idx").collect()
    assert [r.filled for r in filled] == ["Delegación", "Recaudación", "Recaudación", "Devoluciones", "Devoluciones"]
    lab = label_cells(cells, hdr).where("row_idx = 3").orderBy("col_idx").collect()
    assert [r.header for r in lab] == ["Delegación", "Recaudación / IRPF", "Recaudación / IVA", "Devoluciones / IRPF"]
    shape = grid_shape(cells).first()
    assert (shape.n_rows, shape.n_cols) == (6, 5)
    assert [(r.row_idx, r.n_cols, r.header_cols) for r in wider_than_header(cells).collect()] == [(6, 5, 4)]


def test_grid_spine_keeps_blank_rows(spark):
    cells = spark.createDataFrame([("f", "s", 1, 1, "a"), ("f", "s", 3, 2, "b")],
                                  "file string, sheet string, row_idx int, col_idx int, text string")
    g = to_grid(cells).orderBy("row_idx").collect()
    assert [(r.row_idx, r.col_01, r.col_02) for r in g] == [(1, "a", ""), (2, "", ""), (3, "", "b")]
    with pytest.raises(Exception, match="beyond grid width"):
        to_grid(cells, width=1).collect()                      # never drops a cell silently


def test_fetch_outcome_policy(spark):
    rows = [("ok", 1, 200), ("retry_ok", 1, 503), ("retry_ok", 2, 200),
            ("exhausted", 1, 503), ("exhausted", 2, 503), ("exhausted", 3, 503), ("exhausted", 4, 503),
            ("exhausted", 5, 200), ("gone", 1, 404), ("gone", 2, 200), ("net", 1, None), ("net", 2, 200)]
    df = spark.createDataFrame(rows, "request_id string, attempt int, status int")
    got = {r.request_id: (r.attempts_used, r.outcome, r.wait_seconds) for r in fetch_outcome(df).collect()}
    assert got == {"ok": (1, "success", 0), "retry_ok": (2, "success", 2), "exhausted": (4, "exhausted", 14),
                   "gone": (1, "permanent_error", 0), "net": (2, "success", 2)}


def test_request_grid(spark):
    regions = spark.createDataFrame([("Espana", "8741", "peninsular"), ("Madrid", "13", "ccaa")],
                                    "geo_name string, geo_id string, geo_limit string")
    g = request_grid(regions, 2014, 2016, "https://api.example/demand").collect()
    assert len(g) == 6
    u = [r.url for r in g if r.geo_name == "Madrid" and r.year == 2015][0]
    assert u == ("https://api.example/demand?start_date=2015-01-01T00:00&end_date=2015-12-31T23:59"
                 "&time_trunc=month&geo_trunc=electric_system&geo_limit=ccaa&geo_ids=13")
    import datetime as dt
    to_now = request_grid(regions, 2014, None, "https://api.example/demand")
    assert to_now.agg(F.max("year")).first()[0] == dt.date.today().year


def test_manifest(spark):
    m = spark.createDataFrame([("a.xls", "estado", False), ("b.xls", "estado", True)],
                              "file_id string, agent string, is_continuation boolean")
    data = spark.createDataFrame([("a.xls", 1), ("b.xls", 2)], "file string, v int")
    got = sorted((r.file, r.agent, r.is_continuation) for r in tag_with_manifest(data, m, "file").collect())
    assert got == [("a.xls", "estado", False), ("b.xls", "estado", True)]
    extra = data.unionByName(spark.createDataFrame([("zz.xls", 3)], "file string, v int"))
    with pytest.raises(Exception, match="file without manifest row"):
        tag_with_manifest(extra, m, "file").collect()


def test_jdbc_staging_roundtrip(spark, tmp_path):
    """Embedded in-memory Derby (no port).  Spark's Derby dialect binds NULL
    text as CLOB, which Derby refuses for VARCHAR columns, so this round trip
    carries no NULLs (``empty_as_null=False``); the ''->NULL rule itself is
    covered in ``test_delimited_traps``."""
    url = "jdbc:derby:memory:indicata_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(12000).select(F.col("id").cast("string").alias("k"),
                                   F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("v")).alias("val"))
    write_staging(df, url, "STAGING_T", props, empty_as_null=False)
    back = read_table(spark, url, "STAGING_T", props)
    assert back.count() == 12000
    assert back.where(F.col("val") == "a").count() == 4000
    assert back.agg(F.max(F.length("k"))).first()[0] == 5
    # rerun = full reload, not append
    write_staging(df, url, "STAGING_T", props, empty_as_null=False)
    assert read_table(spark, url, "STAGING_T", props).count() == 12000
    wide = spark.createDataFrame([("x" * 501,)], "k string")
    with pytest.raises(Exception, match="(?i)truncat"):
        write_staging(wide, url, "STAGING_W", props, empty_as_null=False)


def test_stage_delimited_entry(spark, tmp_path):
    """Text -> Bronze -> staging -> count check + sample; a too-wide value
    stops the load before it starts."""
    landing = tmp_path / "ipi"
    landing.mkdir()
    (landing / "ipi.csv").write_text("Region;Periodo;Total\nMadrid;2024M01;101,5\nCat;2024M02;99,1\n",
                                     encoding="utf-8-sig")
    url = "jdbc:derby:memory:indicata_stage;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    out = stage_delimited(spark, str(landing), RUN_TS, url, "STAGING_IPI", props, empty_as_null=False)
    assert out["count_check"].first().status == "OK"
    assert [r.Region for r in out["sample"].collect()] == ["Cat", "Madrid"]
    (landing / "ipi.csv").write_text("Region;Periodo;Total\nMadrid;" + "x" * 501 + ";1\n", encoding="utf-8-sig")
    with pytest.raises(ValueError, match="values wider than 500"):
        stage_delimited(spark, str(landing), RUN_TS, url, "STAGING_IPI2", props, empty_as_null=False)


def test_xlsx_rich_text_and_cells_without_refs():
    import io
    import zipfile

    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>'
                           '<sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                                      'relationships"><Relationship Id="rId1" Target="worksheets/s.xml"/>'
                                      '</Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{ns}"><si><r><t>Recau</t></r><r><t>dación</t></r>'
                                '<rPh><t>ふりがな</t></rPh></si></sst>',
        "xl/worksheets/s.xml": f'<worksheet xmlns="{ns}"><sheetData>'
                               '<row><c t="s"><v>0</v></c><c><v>2</v></c></row>'
                               '<row r="4"><c><v>3.5</v></c><c r="D4" t="b"><v>0</v></c></row>'
                               '</sheetData></worksheet>',
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, xml in parts.items():
            z.writestr(name, xml)
    cells = [c[3:] for c in decode_xlsx(buf.getvalue(), "x.xlsx")]
    assert cells == [(1, 1, "s", "Recaudación"), (1, 2, "n", "2"), (4, 1, "n", "3.5"), (4, 4, "b", "0")]


def test_grid_round_trip(spark):
    from indicata.sources.cells import grid_to_cells

    cells = spark.createDataFrame([("f", "s", 1, 1, "a"), ("f", "s", 1, 3, "c"), ("f", "s", 4, 2, "x"),
                                   ("g", "s", 2, 1, "y")],
                                  "file string, sheet string, row_idx int, col_idx int, text string")
    back = grid_to_cells(to_grid(cells))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in cells.collect())
