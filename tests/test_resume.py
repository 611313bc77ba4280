"""M4: unchanged steps are skipped, new files alone are loaded, a killed run goes on where it stopped."""

import os

import pytest

from indicata.plans import run as plan
from indicata.plans.run import RunConfig, run_medallion
from indicata.sinks.run_log import read_log

HEADER = "Region;Indicador;Periodo;Total\n"


def payload(*points):
    values = ",".join(f'{{"datetime":"{t}-01","value":{v}}}' for t, v in points)
    return '{"included":[{"type":"d","attributes":{"values":[' + values + "]}}]}"


def setup(spark, tmp_path):
    landing = tmp_path / "ipi"
    landing.mkdir()
    (landing / "a b.csv").write_text(HEADER + "Madrid;x;2024M01;1,5\nMadrid;x;2024M02;2\nbad;row;of;five;fields\n",
                                     encoding="utf-8")
    spark.createDataFrame([("Madrid", 2024, payload(("2024-01", 10), ("2024-02", 20)))],
                          "geo_name string, year int, body string").write.parquet(str(tmp_path / "energy"))

    def conf(name):
        return RunConfig(lake=str(tmp_path / name), log=str(tmp_path / f"{name}-log"),
                         energy_payloads=str(tmp_path / "energy"),
                         delimited={"ipi": {"landing": str(landing), "region_col": "Region",
                                            "indicator_col": "Indicador", "period_col": "Periodo",
                                            "value_col": "Total"}})
    return landing, conf


def state(out):
    return {t: sorted(map(str, out[t].collect())) for t in ("monthly", "measures", "accounting")} | {
        "dim_region": sorted(r.region for r in out["dim_region"].collect()),   # keys follow the order of the loads
        "silver": sorted(str(r) for r in out["silver_ipi"].select("region", "period", "value", "status").collect())}


def events(spark, conf, event):
    return [r.step for r in read_log(spark, conf.log).where(f"event = '{event}'").orderBy("ts").collect()]


def forbid(monkeypatch, *names):
    def never(*_, **__):
        raise AssertionError("an unchanged input was read again")
    for name in names:
        monkeypatch.setattr(plan, name, never)


STEPS = ["bronze_ipi", "silver_ipi", "bronze_energy", "silver_energy", "gold"]


def test_a_second_run_reads_no_payload(spark, tmp_path, monkeypatch):
    _, conf = setup(spark, tmp_path)
    first = state(run_medallion(spark, conf("lake")))
    forbid(monkeypatch, "bronze_delimited", "silver_delimited", "bronze_energy", "silver_energy", "energy_documents",
           "build_star")
    assert state(run_medallion(spark, conf("lake"))) == first
    assert events(spark, conf("lake"), "success") == events(spark, conf("lake"), "skipped") == STEPS
    monkeypatch.undo()
    other = conf("lake")
    other.regions = ["Madrid", "New"]   # Gold depends on it, nothing else does
    forbid(monkeypatch, "bronze_delimited", "bronze_energy", "silver_energy")
    assert len(state(run_medallion(spark, other))["dim_region"]) == len(first["dim_region"]) + 1


def test_new_files_alone_are_loaded(spark, tmp_path, monkeypatch):
    landing, conf = setup(spark, tmp_path)
    run_medallion(spark, conf("lake"))
    (landing / "c.csv").write_text("Indicador;Region;Periodo;Total;More\nx;Madrid;2024M03;4;m\ny;Cat;2024M01;x\n",
                                   encoding="utf-8")
    read, plain = [], plan.bronze_delimited
    monkeypatch.setattr(plan, "bronze_delimited", lambda s, p, *a, **k: read.append(p) or plain(s, p, *a, **k))
    forbid(monkeypatch, "bronze_energy", "silver_energy")
    got = run_medallion(spark, conf("lake"))
    assert [os.path.basename(x) for x in read[0]] == ["c.csv"]
    assert spark.read.parquet(str(tmp_path / "lake" / "bronze" / "ipi" / "load=2")).count() == 2
    monkeypatch.undo()
    assert state(got) == state(run_medallion(spark, conf("fresh")))
    assert sorted(r.Total for r in got["bronze_ipi"].collect()) == ["1,5", "2", "4", "x"]
    again = state(run_medallion(spark, conf("lake")))
    assert again == state(got) and events(spark, conf("lake"), "skipped").count("silver_ipi_2") == 1


def test_a_changed_file_loads_its_source_anew(spark, tmp_path, monkeypatch):
    landing, conf = setup(spark, tmp_path)
    (landing / "b.csv").write_text(HEADER + "Cat;x;2024M01;7\n", encoding="utf-8")
    run_medallion(spark, conf("lake"))
    (landing / "c.csv").write_text(HEADER + "Cat;x;2024M02;8\n", encoding="utf-8")
    run_medallion(spark, conf("lake"))
    (landing / "b.csv").write_text(HEADER + "Cat;x;2024M01;9\nCat;y;2024M05;1\n", encoding="utf-8")
    got = state(run_medallion(spark, conf("lake")))
    assert got == state(run_medallion(spark, conf("fresh")))
    assert sorted(os.listdir(tmp_path / "lake" / "bronze" / "ipi")) == ["load=1"]
    os.remove(landing / "c.csv")
    got = state(run_medallion(spark, conf("lake")))
    assert not any("8.0000" in x for x in got["monthly"])


@pytest.mark.parametrize("killed", ["silver_delimited", "silver_energy", "derive_measures"])
def test_a_killed_run_goes_on(spark, tmp_path, monkeypatch, killed):
    _, conf = setup(spark, tmp_path)

    def kill(*_, **__):
        raise RuntimeError("killed")
    monkeypatch.setattr(plan, killed, kill)
    with pytest.raises(RuntimeError, match="killed"):
        run_medallion(spark, conf("lake"))
    done = events(spark, conf("lake"), "success")
    monkeypatch.undo()
    assert state(run_medallion(spark, conf("lake"))) == state(run_medallion(spark, conf("fresh")))
    assert events(spark, conf("lake"), "skipped") == done
    assert sorted(events(spark, conf("lake"), "success")) == sorted(STEPS)
