import os

from pyspark.sql import functions as F

from indicata.plans.bronze import bronze_construction
from indicata.plans.silver import reject_rows, silver_construction, silver_tax, tidy_rows
from indicata.sources.manifest import tag_with_manifest
from indicata.sources.workbook import legacy_text, read_xlsx_cells, xlsx_text

from tests.fixtures import tax_workbook, write_xlsx

RUN_TS = "2024-05-01T10:00:00+00:00"


def test_silver_tax_from_crosstab(spark, tmp_path):
    tax_workbook(str(tmp_path / "wb" / "tax.xlsx"))
    cells = xlsx_text(read_xlsx_cells(spark, str(tmp_path / "wb"), sheet="datos_delegaciones"))
    hdr = spark.createDataFrame([("tax.xlsx", "datos_delegaciones", 2)], "file string, sheet string, header_rows int")
    dmap = spark.createDataFrame([("Madrid", "Comunidad de Madrid"), ("Barcelona", "Cataluña")],
                                 "delegation string, region string")
    seen, unmapped = silver_tax(cells, hdr, dmap, "2024-03-01")
    tidy, rejects = tidy_rows(seen), reject_rows(seen)
    got = sorted((r.region, r.measure, str(r.value)) for r in tidy.collect())
    assert ("Comunidad de Madrid", "Recaudación / IRPF", "1500.0000") in got
    assert ("Comunidad de Madrid", "Devoluciones / IRPF", "500.0000") in got   # cached formula value
    assert ("Cataluña", "Recaudación / IRPF", "5.0000") in got
    assert ("UNMAPPED", "Recaudación / IRPF", "0.0000") in got                   # 1e-05 rounds at scale 4
    assert {r.period.isoformat() for r in tidy.collect()} == {"2024-03-01"}
    assert sorted(r.raw for r in rejects.collect()) == ["#DIV/0!", "2024-01-30 12:00:00", "True", "x"]
    assert [(r.delegation, r.n_rows) for r in unmapped.collect()] == [("Atlantis", 4)]   # every cell of its rows, blank and rejected ones too


def _construction_book(path, rows):
    cells = {(1, 1): ("s", "Periodo"), (1, 2): ("s", "Licitación"), (2, 2): ("s", "Importe"), (2, 3): ("s", "Número")}
    for i, (period, amount, count) in enumerate(rows, 3):
        cells[(i, 1)] = ("s", period)
        cells[(i, 2)] = ("n", amount)
        cells[(i, 3)] = ("n", count)
    return write_xlsx(path, {"Hoja1": cells})


def test_construction_first_and_continuation(spark, tmp_path):
    folder = str(tmp_path / "cons")
    _construction_book(os.path.join(folder, "A1.xlsx"), [("2024M01", "1000.0", "3"), ("2024M02", "2000.5", "4")])
    _construction_book(os.path.join(folder, "A2.xlsx"), [("2024M03", "1500", "2")])
    manifest = spark.createDataFrame([("A1.xlsx", "estado", False, 2), ("A2.xlsx", "estado", True, 2)],
                                     "file_id string, agent string, is_continuation boolean, header_rows int")
    bronze = bronze_construction(spark, folder, manifest, RUN_TS).orderBy("_source_file", "_row_number").collect()
    assert [(r._source_file, r._row_number, r.col_02) for r in bronze][:4] == [
        ("A1.xlsx", 1, "Licitación"), ("A1.xlsx", 2, "Importe"), ("A1.xlsx", 3, "1000"), ("A1.xlsx", 4, "2000.5")]
    assert {(r._source_file, r.contracting_agent, r.is_continuation) for r in bronze} == {
        ("A1.xlsx", "estado", False), ("A2.xlsx", "estado", True)}
    cells = tag_with_manifest(legacy_text(read_xlsx_cells(spark, folder, sheet_index=0)),
                              manifest.select("file_id", F.col("agent").alias("contracting_agent")), "file")
    hdr = manifest.select(F.col("file_id").alias("file"), F.lit("Hoja1").alias("sheet"), "header_rows")
    seen = silver_construction(cells, hdr)
    tidy, rejects = tidy_rows(seen), reject_rows(seen)
    got = sorted((str(r.period), r.measure, str(r.value)) for r in tidy.collect())
    assert got == [("2024-01-01", "Licitación / Importe", "1000.0000"), ("2024-01-01", "Licitación / Número", "3.0000"),
                   ("2024-02-01", "Licitación / Importe", "2000.5000"), ("2024-02-01", "Licitación / Número", "4.0000"),
                   ("2024-03-01", "Licitación / Importe", "1500.0000"), ("2024-03-01", "Licitación / Número", "2.0000")]
    assert rejects.count() == 0
