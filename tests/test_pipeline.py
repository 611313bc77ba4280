import os

import pytest
from pyspark.sql import functions as F

from indicata.plans.run import RunConfig, run_medallion
from indicata.plans.silver import reject_rows
from indicata.sinks.run_log import read_log
from indicata.streaming.landing import start_landing

from tests.fixtures import ipi_csv, tax_workbook, write_xlsx
from tests.test_workbook_silver import _construction_book
from tests.test_sources import PAYLOADS


def test_run_medallion_end_to_end(spark, tmp_path):
    landing = os.path.dirname(ipi_csv(str(tmp_path / "landing" / "ipi" / "ipi.csv")))
    payloads = str(tmp_path / "landing" / "energy")
    spark.createDataFrame(PAYLOADS, "geo_name string, year int, body string").write.parquet(payloads)
    conf = RunConfig(
        lake=str(tmp_path / "lake"), log=str(tmp_path / "log"), energy_payloads=payloads,
        delimited={"ipi": {"landing": landing, "region_col": "Comunidades y Ciudades Autónomas",
                           "indicator_col": "Indicador", "period_col": "Periodo", "value_col": "Total"}},
        multiline=True)
    out = run_medallion(spark, conf)
    assert out["bronze_ipi"].count() == 5
    silver_ipi = out["silver_ipi"].where("status = 'ok'").collect()
    assert sorted(str(r.value) for r in silver_ipi) == ["101.5000", "99.0000"]
    rejects = reject_rows(out["silver_ipi"]).where("column = 'value'").collect()
    assert [r.raw for r in rejects] == ["Total"]                  # the repeated header row; NA and '' are blanks
    quarantined = spark.read.parquet(str(tmp_path / "lake" / "quarantine" / "ipi")).collect()
    assert len(quarantined) == 1                                  # the overlong row
    assert out["fact"].count() > 0
    log = read_log(spark, conf.log)
    assert log.where("event = 'start'").count() == log.where("event = 'success'").count() == 5
    bronze_rows = log.where("step = 'bronze_ipi' and event = 'success'").first().rows_out
    assert bronze_rows == 5
    keys_before = {r.region: r.region_key for r in spark.read.parquet(str(tmp_path / "lake" / "gold" / "dim_region")).collect()}
    # rerun overwrites, never appends; a new region keeps the old keys stable
    conf.regions = ["Aaa-new"]
    run_medallion(spark, conf)
    assert spark.read.parquet(str(tmp_path / "lake" / "bronze" / "ipi")).count() == 5
    keys_after = {r.region: r.region_key for r in spark.read.parquet(str(tmp_path / "lake" / "gold" / "dim_region")).collect()}
    assert all(keys_after[k] == v for k, v in keys_before.items())
    assert keys_after["Aaa-new"] == max(keys_before.values()) + 1


def test_landing_stream_reads_each_file_once(spark, tmp_path):
    landing = tmp_path / "drop"
    landing.mkdir()
    (landing / "a.csv").write_text("k;v\n1;x\n2;\n", encoding="utf-8")
    target, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    start_landing(spark, str(landing), target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    (landing / "b.csv").write_text("k;v\n3;y\n", encoding="utf-8")
    start_landing(spark, str(landing), target, ckpt).awaitTermination()
    got = spark.read.parquet(target)
    assert got.count() == 3
    assert sorted(r.v for r in got.collect()) == ["", "x", "y"]
    assert {r._source_file for r in got.select("_source_file").collect()} == {"a.csv", "b.csv"}
    assert got.where(F.col("_ingestion_timestamp").endswith("+00:00")).count() == 3


def test_run_medallion_all_sources(spark, tmp_path):
    cons = str(tmp_path / "landing" / "cons")
    _construction_book(os.path.join(cons, "A1.xlsx"), [("2024M01", "1000.0", "3")])
    _construction_book(os.path.join(cons, "A2.xlsx"), [("2024M02", "1500", "2")])
    tax_workbook(str(tmp_path / "landing" / "tax" / "tax.xlsx"))
    conf = RunConfig(
        lake=str(tmp_path / "lake"), log=str(tmp_path / "log"),
        construction_workbooks=cons,
        construction_manifest=[("A1.xlsx", "estado", False, 2), ("A2.xlsx", "estado", True, 2)],
        tax_workbooks=str(tmp_path / "landing" / "tax"), tax_period="2024-03-01", tax_header_rows=2,
        delegation_map=[("Madrid", "Comunidad de Madrid"), ("Barcelona", "Cataluña")],
        measures={f"{a} / {b}": ("EUR", True) for a in ("Licitación", "Recaudación", "Devoluciones")
                  for b in ("Importe", "Número", "IRPF", "IVA")})
    out = run_medallion(spark, conf)
    silver = out["silver_construction"].where("status = 'ok'")
    assert sorted((str(r.period), r.measure, str(r.value)) for r in silver.collect()) == [
        ("2024-01-01", "Licitación / Importe", "1000.0000"), ("2024-01-01", "Licitación / Número", "3.0000"),
        ("2024-02-01", "Licitación / Importe", "1500.0000"), ("2024-02-01", "Licitación / Número", "2.0000")]
    tax = out["silver_tax"].where("status = 'ok'")
    assert tax.where("region = 'Comunidad de Madrid'").count() == 3
    assert spark.read.parquet(str(tmp_path / "lake" / "quality" / "tax_unmapped")).first().delegation == "Atlantis"
    fact = spark.read.parquet(str(tmp_path / "lake" / "gold" / "fact"))
    sources = {r.source for r in spark.read.parquet(str(tmp_path / "lake" / "gold" / "dim_source")).collect()}
    assert {"construction", "tax"} <= sources and fact.count() == silver.count() + tax.count()
    assert os.path.isdir(str(tmp_path / "lake" / "bronze" / "construction" / "_source_file=A1.xlsx"))
    parts = sorted(p for p in os.listdir(str(tmp_path / "lake" / "gold" / "fact")) if p.startswith("source_key="))
    assert len(parts) == 2                                          # fact partitioned by source
    pruned = fact.where("source_key = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_key" in pruned


def _tax_book(path, rows):
    cells = {(1, 1): ("s", "Delegación"), (1, 2): ("s", "IRPF")}
    for i, (name, value) in enumerate(rows, 2):
        cells[(i, 1)], cells[(i, 2)] = ("s", name), ("n", value)
    return write_xlsx(path, {"datos_delegaciones": cells})


def test_delegations_of_a_region_are_summed_by_month(spark, tmp_path):
    _tax_book(str(tmp_path / "tax" / "jan.xlsx"), [("Sevilla", "100"), ("Cádiz", "40"), ("Nowhere", "1"), ("Elsewhere", "2")])
    _tax_book(str(tmp_path / "tax" / "feb.xlsx"), [("Sevilla", "7")])
    conf = RunConfig(lake=str(tmp_path / "lake"), log=str(tmp_path / "log"), tax_workbooks=str(tmp_path / "tax"),
                     tax_period={"jan.xlsx": "2024-01-01", "feb.xlsx": "2024-02-01"},
                     delegation_map=[("Sevilla", "Andalucía"), ("Cádiz", "Andalucía")], measures={"IRPF": ("EUR", True)})
    out = run_medallion(spark, conf)
    got = {(r.region, r.period.month): float(r.value) for r in out["monthly"].collect()}
    assert got == {("Andalucía", 1): 140, ("Andalucía", 2): 7, ("UNMAPPED", 1): 3}
    assert {r.detail for r in out["silver_tax"].collect()} == {"Sevilla", "Cádiz", "Nowhere", "Elsewhere"}
    # a workbook that left the landing leaves the lake, too
    os.remove(str(tmp_path / "tax" / "feb.xlsx"))
    assert run_medallion(spark, conf)["bronze_tax"].select("_source_file").distinct().count() == 1
    conf.tax_period = {"other.xlsx": "2024-01-01"}
    with pytest.raises(Exception, match="workbook without a period"):
        run_medallion(spark, conf)


def test_scope_keeps_older_months_and_documents_count_once(spark, tmp_path):
    def payload(*points):
        values = ",".join(f'{{"datetime":"{t}-01","value":{v}}}' for t, v in points)
        return '{"included":[{"type":"d","attributes":{"values":[' + values + "]}}]}"
    rows = [("Madrid", 2023, payload(("2023-01", 10), ("2023-02", 20))),
            ("Madrid", 2024, payload(("2024-01", 20), ("2024-01", 5), ("2024-02", 30)))]
    landed = str(tmp_path / "energy")
    spark.createDataFrame([*rows, rows[0]], "geo_name string, year int, body string").write.parquet(landed)
    conf = RunConfig(lake=str(tmp_path / "lake"), log=str(tmp_path / "log"), energy_payloads=landed)
    first = {(r.period.isoformat()): (float(r.value), r.yoy) for r in run_medallion(spark, conf)["measures"].collect()}
    assert first == {"2023-01-01": (10.0, None), "2023-02-01": (20.0, None), "2024-01-01": (25.0, 1.5),
                     "2024-02-01": (30.0, 0.5)}
    assert spark.read.parquet(str(tmp_path / "lake" / "quality" / "duplicates")).first().copies == 2
    conf.data_scope = "since=2024-01"
    again = {(r.period.isoformat()): (float(r.value), r.yoy) for r in run_medallion(spark, conf)["measures"].collect()}
    assert again == first
    log = read_log(spark, conf.log).where("event = 'success'")
    assert log.where("step = 'silver_energy'").first().rows_in == 10


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from indicata import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": lambda self, key, default=None: default})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_fixed_coverage(spark):
    from indicata.plans.run import construction_manifest, energy_requests

    urls = energy_requests(spark, "https://api.example/demand", 2015)
    assert urls.count() == 6 and urls.where("geo_name = 'Madrid' AND year = 2014").first().geo_id == "13"
    assert construction_manifest(2)[1] == ("01401600.xlsx", "estado", True, 2)
