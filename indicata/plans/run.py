"""M4 — one call runs Bronze -> Silver -> Gold, logging and checking every step.

Plain ordered calls; each step writes its table (Parquet under the lake
root) and appends ``start``/``success``/``failure`` rows with row counts to
the run log.  A ledger keeps what each finished step was made from (files with
size and time, configuration): a step whose inputs and configuration are as
they were is ``skipped``, so a run that failed goes on where it stopped, and
new files of a delimited landing are loaded alone, beside what is there.
Changed or removed files load their source anew.

Every landed observation is accounted for: what Bronze holds equals what
Silver accepted, found blank and rejected, and what Silver accepted sums up to
the fact (additive measures; others as exact means), per source; otherwise the run fails.  Tables per source:

* ``bronze/<source>``, ``quarantine/<source>`` (whole records of malformed rows); delimited sources have a folder
  ``load=<n>`` per load of new files, there and in Silver,
* ``silver/<source>/status=ok|blank|reject|superseded`` (one write of the typed observations),
  ``history/energy`` (older versions of revised observations, with the times in which they held),
* ``quality/accounting`` (rows and sums per layer and source), ``quality/duplicates``
  (documents landed more than once, used once), ``quality/tax_unmapped``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indicata.operators.bronze import run_stamp
from indicata.operators.quality import totals_vs_expected
from indicata.operators.silver import apply_scope, consolidate, roll_up
from indicata.plans.bronze import TAX_SHEET, bronze_construction, bronze_delimited, bronze_energy, bronze_tax
from indicata.plans.gold import additive, build_star, clustered, derive_measures
from indicata.plans.silver import (TIDY_KEY, energy_history, silver_construction, silver_delimited, silver_energy,
                                   silver_tax, tidy_rows)
from indicata.functions.text import file_name
from indicata.sources.cells import grid_to_cells, wider_than_header
from indicata.sinks.files import materialize
from indicata.sinks.ledger import Ledger, digest, fingerprint, listing
from indicata.sinks.run_log import StepLogger, observed, read_log

DIMENSIONS = ("dim_region", "dim_calendar", "dim_source", "dim_indicator", "dim_measure")

# The regions and the first year that the demand source is asked for, and the construction files.
ENERGY_REGIONS = (
    {"geo_name": "Espana", "geo_id": "8741", "geo_limit": "peninsular"},
    {"geo_name": "Madrid", "geo_id": "13", "geo_limit": "ccaa"},
    {"geo_name": "Catalunya", "geo_id": "9", "geo_limit": "ccaa"},
)
ENERGY_START_YEAR = 2014
CONSTRUCTION_FILES = (
    ("01401400.XLS", "estado", False),
    ("01401600.XLS", "estado", True),
    ("01402600.XLS", "entes", False),
    ("01402800.XLS", "entes", True),
)


def energy_requests(spark: SparkSession, base_url: str, end_year: int | None = None) -> DataFrame:
    """The request grid of the demand source: its regions, from its first to the current year."""
    from indicata.sources.requests import request_grid

    regions = spark.createDataFrame([(r["geo_name"], r["geo_id"], r["geo_limit"]) for r in ENERGY_REGIONS],
                                    "geo_name string, geo_id string, geo_limit string")
    return request_grid(regions, ENERGY_START_YEAR, end_year or date.today().year, base_url)


def construction_manifest(header_rows: int, suffix: str = ".xlsx") -> list[tuple]:
    """Manifest rows of the fixed construction files, landed as workbooks of that suffix."""
    return [(name.rsplit(".", 1)[0] + suffix, agent, more, header_rows) for name, agent, more in CONSTRUCTION_FILES]


@dataclass
class RunConfig:
    lake: str                       # root folder of Bronze/Silver/Gold tables
    log: str                        # run-log table folder
    delimited: dict[str, dict] = field(default_factory=dict)   # source -> {landing, region_col, ...}
    multiline: bool = False         # quoted line breaks in delimited files (then each file is one task)
    energy_payloads: str | None = None  # Parquet of (geo_name, year, body)
    energy_api_path: str = "/api/demand"
    regions: list[str] = field(default_factory=list)
    data_scope: str = "full_history"
    # workbooks: folder of XLSX files; manifest rows (file_id, agent, is_continuation, header_rows)
    construction_workbooks: str | None = None
    construction_manifest: list[tuple] = field(default_factory=lambda: construction_manifest(1))
    tax_workbooks: str | None = None
    tax_period: str | dict[str, str] | None = None   # month of the tax crosstab (YYYY-MM-DD), or by workbook
    tax_header_rows: int = 1
    delegation_map: list[tuple] = field(default_factory=list)   # (delegation, region)
    # dimension attributes beside the fixed ones: measure -> (unit, additive), region -> parent, indicator -> (code, name)
    measures: dict[str, tuple[str, bool]] = field(default_factory=dict)
    parents: dict[str, str] = field(default_factory=dict)
    indicators: dict[str, tuple[str, str]] = field(default_factory=dict)


#: What became of a landed observation.
STATUSES = ("ok", "blank", "reject", "superseded")


class LossError(RuntimeError):
    """Rows or sums of two layers differ."""


def previous_gold(spark: SparkSession, conf: RunConfig) -> dict[str, DataFrame]:
    """Last run's dimensions and monthly table, if a run completed its Gold
    step (the run log says so), copied to the shared scratch folder first so
    the Gold paths can be overwritten while keys and months are carried over."""
    done = (read_log(spark, conf.log).where((F.col("step") == "gold") & (F.col("event") == "success"))
            .limit(1).count())
    if not done:
        return {}
    return {name: materialize(spark.read.parquet(f"{conf.lake}/gold/{name}"), f"prev_{name}")
            for name in (*DIMENSIONS, "monthly")}


def _write(df: DataFrame, path: str, step: str, info: dict, partition_by: list[str] | None = None,
           metrics: dict | None = None) -> DataFrame:
    """Write a table whole (what an earlier run left there goes), count its
    rows on the way, and read it with the schema it was written with."""
    df, obs = observed(df, step, metrics)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    got = obs.get
    info["rows_out"] = got.get("rows", 0)
    info["metrics"] = got
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Run:
    """What the steps of one run share."""

    def __init__(self, spark: SparkSession, conf: RunConfig):
        self.spark, self.conf = spark, conf
        self.log, self.ts = StepLogger(spark, conf.log), run_stamp()
        self.ledger = Ledger(spark, f"{conf.lake}/ledger")
        self.marks: dict[str, str] = {}   # fingerprints of the sources as they are now
        self.out: dict[str, DataFrame] = {}
        self.parts: list[DataFrame] = []
        self.accounts: list[tuple] = []   # (source, layer, rows, total)

    def step(self, name: str, mark: str, work: Callable[[dict], None], tables: dict[str, str],
             files: DataFrame | None = None, load: int = 1) -> None:
        """Do a step and enter it in the ledger, or, if it was done from the same, take over what it left: its tables
        (name -> folder) and its accounts."""
        last = self.ledger.last(name)
        if last is not None and last.fingerprint == mark:
            self.log.event(name, "skipped")
        else:
            accounts = len(self.accounts)
            with self.log.step(name) as info:
                work(info)
                state = {"accounts": self.accounts[accounts:], "rows": info.get("rows_out"), "load": load,
                         "schemas": {t: self.out[t].schema.jsonValue() for t in tables if t in self.out}}
                last = self.ledger.done(name, last.number + 1 if last else 1, mark, state, files)
            del self.accounts[accounts:]
        self.accounts += [(*a[:3], Decimal(a[3]) if a[3] is not None else None) for a in last.state["accounts"]]
        for table, path in tables.items():
            if table in last.state["schemas"]:
                schema = StructType.fromJson(last.state["schemas"][table])
                self.out[table] = self.spark.read.schema(schema).parquet(path)

    def bronze(self, name: str, df: DataFrame, info: dict, partition_by: list[str] | None = None,
               path: str | None = None) -> DataFrame:
        self.out[f"bronze_{name}"] = _write(df, path or f"{self.conf.lake}/bronze/{name}", f"bronze_{name}", info,
                                            partition_by)
        return self.out[f"bronze_{name}"]

    def silver(self, name: str, observations: DataFrame, landed: int, info: dict, path: str | None = None) -> None:
        """One write of the typed observations; fails unless each landed one is there."""
        ok = F.col("status") == "ok"
        table = _write(observations, path or f"{self.conf.lake}/silver/{name}", f"silver_{name}", info, ["status"], {
            **{s: F.count_if(F.col("status") == s) for s in STATUSES},
            "rounded": F.count_if(ok & F.col("rounded")),
            "total": F.sum(F.when(ok, F.col("value"))).cast("decimal(38,4)")})
        got = info["metrics"]
        info["rows_in"] = landed
        self.accounts.append((name, "landed", landed, None))
        self.accounts += [(name, f"silver_{s}", got[s], got["total"] if s == "ok" else None)
                          for s in STATUSES if s != "superseded" or got[s]]
        self.accounts.append((name, "silver_rounded", got["rounded"], None))
        if got["rows"] != landed:
            raise LossError(f"{name}: {landed} observations landed, Silver has {got['rows']}")
        self.out[f"silver_{name}"] = table


def _data_cells(cells: DataFrame, header_rows: dict[str, int] | int, label_col: int = 1) -> int:
    """Cells below the header and beside the label, counted apart from the Silver build."""
    if isinstance(header_rows, int):
        first = F.lit(header_rows)
    else:
        first = F.try_element_at(F.create_map(*[F.lit(x) for kv in header_rows.items() for x in kv]), F.col("file"))
    below = (F.col("row_idx") > F.coalesce(first, F.lit(0))) & (F.col("col_idx") != label_col)
    return cells.agg(F.count_if(below)).first()[0]


def _delimited(run: _Run, name: str, opts: dict) -> None:
    """New files are a load of their own, beside the earlier ones; if files changed or went away, or the settings
    differ, the first load starts anew with all files."""
    conf, spark = run.conf, run.spark
    lake, settings = conf.lake, fingerprint("delimited", opts, conf.multiline)
    files = materialize(listing(spark, opts["landing"]).where(F.col("length") > 0), "landing_files")
    mark = fingerprint(settings, digest(files))
    last = run.ledger.last(f"bronze_{name}")
    fresh = None
    if last is not None and last.state["settings"] == settings:
        fresh = run.ledger.added(files, last)
    load = 1 if fresh is None else last.state["load"] + bool(fresh)
    loads = [] if load == 1 else last.state["loads"]
    unchanged = last is not None and last.fingerprint == mark
    if unchanged:
        load, loads, fresh = last.state["load"], last.state["loads"][:-1], []

    def bronze(info: dict) -> None:
        if load == 1:
            _clear(spark, f"{lake}/bronze/{name}", f"{lake}/quarantine/{name}", f"{lake}/silver/{name}")
        rows, malformed = bronze_delimited(spark, fresh or opts["landing"], run.ts, multiline=conf.multiline)
        table = run.bronze(name, rows, info, path=f"{lake}/bronze/{name}/load={load}")
        malformed, obs = observed(malformed, f"quarantine_{name}")
        malformed.write.mode("overwrite").parquet(f"{lake}/quarantine/{name}/load={load}")
        info["rows_in"] = info["rows_out"] + obs.get.get("rows", 0)
        info["load"] = {"rows": info["rows_out"], "quarantined": obs.get.get("rows", 0),
                        "schema": table.schema.jsonValue(), "mark": mark}

    if unchanged:
        run.log.event(f"bronze_{name}", "skipped")
        loads = last.state["loads"]
    else:
        with run.log.step(f"bronze_{name}") as info:
            bronze(info)
            loads = [*loads, info["load"]]
            run.ledger.done(f"bronze_{name}", last.number + 1 if last else 1, mark,
                            {"settings": settings, "load": load, "loads": loads}, files)
    run.marks[name] = mark
    run.accounts.append((name, "quarantine", sum(x["quarantined"] for x in loads), None))
    schemas = [StructType.fromJson(x["schema"]) for x in loads]
    bronzes = [spark.read.schema(schema).parquet(f"{lake}/bronze/{name}/load={i}") for i, schema in enumerate(schemas, 1)]
    silvers = []
    for i, (rows, told) in enumerate(zip(bronzes, loads), 1):
        path = f"{lake}/silver/{name}/load={i}"

        def silver(info: dict, rows=rows, told=told, path=path) -> None:
            run.silver(name, silver_delimited(
                rows, name, opts["region_col"], opts["indicator_col"], opts["period_col"], opts["value_col"],
                opts.get("measure", "index"), opts.get("decimal_comma", True)), told["rows"], info, path)

        # the first load keeps the plain step name
        run.step(f"silver_{name}" + (f"_{i}" if i > 1 else ""), told["mark"], silver, {f"silver_{name}": path})
        silvers.append(run.out[f"silver_{name}"])
    run.out[f"bronze_{name}"] = consolidate(bronzes)
    run.out[f"silver_{name}"] = consolidate(silvers)
    run.accounts[:] = _summed(run.accounts)


def _summed(accounts: list[tuple]) -> list[tuple]:
    """One account per source and layer, those of several loads added up, in the order in which they came."""
    out: dict[tuple[str, str], tuple] = {}
    for source, layer, rows, total in accounts:
        n, s = out.get((source, layer), (0, None))
        out[source, layer] = (n + rows, total if s is None else s if total is None else s + total)
    return [(*k, *v) for k, v in out.items()]


def _clear(spark: SparkSession, *paths: str) -> None:
    """Remove what earlier loads of a source left in the lake."""
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def _energy(run: _Run) -> None:
    conf = run.conf
    mark = run.marks["energy"] = fingerprint("energy", conf.energy_api_path, digest(listing(
        run.spark, conf.energy_payloads, "*.parquet")))

    def bronze(info: dict) -> None:
        landed = run.spark.read.parquet(conf.energy_payloads)
        # a document landed twice is the same request answered twice: used once, as of the first time, and reported
        if "loaded_at" not in landed.columns:
            landed = landed.withColumn("loaded_at", F.col("_metadata.file_modification_time"))
        request = [c for c in landed.columns if c not in ("body", "loaded_at")]
        payloads = energy_documents(landed, request)
        twice = payloads.where("copies > 1").select(*request, "copies", F.sha2("body", 256).alias("body_sha256"))
        twice.write.mode("overwrite").parquet(f"{conf.lake}/quality/duplicates")
        info["rows_in"] = payloads.count()
        known = payloads.withColumnRenamed("loaded_at", "_loaded_at").drop("copies")
        run.bronze("energy", bronze_energy(known, run.ts, conf.energy_api_path), info)

    def silver(info: dict) -> None:
        bronze = run.out["bronze_energy"]
        run.silver("energy", silver_energy(bronze), 2 * run.ledger.last("bronze_energy").state["rows"], info)
        run.out["history_energy"] = _write(energy_history(run.out["silver_energy"]), f"{conf.lake}/history/energy",
                                           "history_energy", {})

    run.step("bronze_energy", mark, bronze, {"bronze_energy": f"{conf.lake}/bronze/energy"})
    run.step("silver_energy", mark, silver, {"silver_energy": f"{conf.lake}/silver/energy",
                                             "history_energy": f"{conf.lake}/history/energy"})


def energy_documents(landed: DataFrame, request: list[str]) -> DataFrame:
    """The documents that count, written once: ``request…, body, loaded_at,
    copies``.  A body that answers a request again, as the one before it did,
    is a copy; one that comes back after another is a revision like any.  Two
    different bodies of one request with one load time can't be put in order:
    that fails the job."""
    loads = landed.groupBy(*request, "loaded_at").agg(
        F.count(F.lit(1)).alias("n"), F.min("body").alias("body"), F.max("body").alias("other"))
    unclear = F.raise_error(F.concat(F.lit("two answers to one request at one load time: "),
                                     F.to_json(F.struct(*request, "loaded_at")))).cast("string")
    loads = loads.withColumn("body", F.when(F.col("body") == F.col("other"), F.col("body")).otherwise(unclear))
    w = Window.partitionBy(*request).orderBy("loaded_at")
    runs = loads.withColumn("first", ~F.lag("body").over(w).eqNullSafe(F.col("body")) | F.lag("n").over(w).isNull())
    runs = runs.withColumn("version", F.sum(F.col("first").cast("int")).over(w))
    documents = runs.groupBy(*request, "version").agg(
        F.min_by("body", "loaded_at").alias("body"), F.min("loaded_at").alias("loaded_at"), F.sum("n").alias("copies"))
    return materialize(documents.drop("version"), "energy_documents")


def _construction(run: _Run) -> None:
    conf = run.conf
    manifest = run.spark.createDataFrame(
        conf.construction_manifest, "file_id string, agent string, is_continuation boolean, header_rows int")
    mark = run.marks["construction"] = fingerprint("construction", conf.construction_manifest, digest(listing(
        run.spark, conf.construction_workbooks, "*.xlsx")))

    def bronze(info: dict) -> None:
        run.bronze("construction", bronze_construction(run.spark, conf.construction_workbooks, manifest, run.ts), info,
                   ["_source_file"])

    def silver(info: dict) -> None:
        grid = run.out["bronze_construction"].withColumn("sheet", F.lit("")).withColumnRenamed("_source_file", "file")
        grid = grid.withColumn("label", F.nullif("col_01", F.lit("")))
        cells = grid_to_cells(grid, row_col="_row_number", extra=("contracting_agent", "label"))
        header = manifest.select(F.col("file_id").alias("file"), F.lit("").alias("sheet"), "header_rows")
        landed = _data_cells(cells, {m[0]: m[3] for m in conf.construction_manifest})
        run.silver("construction", silver_construction(cells, header), landed, info)

    run.step("bronze_construction", mark, bronze, {"bronze_construction": f"{conf.lake}/bronze/construction"})
    run.step("silver_construction", mark, silver, {"silver_construction": f"{conf.lake}/silver/construction"})


def _tax(run: _Run) -> None:
    conf = run.conf
    files = listing(run.spark, conf.tax_workbooks, "*.xlsx")
    mark = fingerprint("tax", digest(files))
    rules = fingerprint(mark, conf.tax_period, conf.tax_header_rows, conf.delegation_map)
    run.marks["tax"] = rules

    def bronze(info: dict) -> None:
        run.bronze("tax", bronze_tax(run.spark, conf.tax_workbooks, run.ts, sheet=TAX_SHEET), info, ["_source_file"])

    def silver(info: dict) -> None:
        # one row per landed workbook, from the file listing (contents not read)
        header = files.select(file_name(F.col("path")).alias("file"), F.lit(TAX_SHEET).alias("sheet"),
                              F.lit(conf.tax_header_rows).alias("header_rows"))
        if isinstance(conf.tax_period, str) and header.limit(2).count() > 1:
            raise ValueError("several tax workbooks need a period each: tax_period={file: month}")
        grid = run.out["bronze_tax"].withColumn("sheet", F.lit(TAX_SHEET)).withColumnRenamed("_source_file", "file")
        grid = grid.withColumn("label", F.nullif("col_01", F.lit("")))
        cells = grid_to_cells(grid, row_col="_row_number", extra=("label",))
        regions = run.spark.createDataFrame(conf.delegation_map, "delegation string, region string")
        observations, unmapped = silver_tax(cells, header, regions, conf.tax_period)
        unmapped.write.mode("overwrite").parquet(f"{conf.lake}/quality/tax_unmapped")
        # rows beyond the first one's width, which a loader sized by row 1 would lose
        wider_than_header(cells).write.mode("overwrite").parquet(f"{conf.lake}/quality/tax_wider")
        run.silver("tax", observations, _data_cells(cells, conf.tax_header_rows), info)

    run.step("bronze_tax", mark, bronze, {"bronze_tax": f"{conf.lake}/bronze/tax"})
    run.step("silver_tax", rules, silver, {"silver_tax": f"{conf.lake}/silver/tax"})


def _monthly(run: _Run, previous: DataFrame | None) -> DataFrame:
    """One row per tidy key.  With a scope, months before it and sources that
    this run doesn't load keep what the last run left."""
    rows = consolidate(run.parts)
    scoped = apply_scope(rows, "period", run.conf.data_scope)
    monthly = roll_up(scoped, TIDY_KEY, additive(F.col("measure"), run.conf.measures))
    if previous is None:
        return monthly
    loaded = list(run.marks)
    kept = ~F.col("source").isin(loaded)
    if scoped is not rows:
        kept = kept | ~_in_scope(run.conf.data_scope)
    return monthly.unionByName(previous.where(kept).select(*TIDY_KEY, "value"))


def _in_scope(scope: str):
    month = scope.split("=", 1)[1]
    return F.col("period") >= F.lit(f"{month}-01" if len(month) == 7 else month).cast("date")


def run_medallion(spark: SparkSession, conf: RunConfig) -> dict[str, DataFrame]:
    """Run every configured source through the three layers."""
    run = _Run(spark, conf)
    for name, opts in conf.delimited.items():
        _delimited(run, name, opts)
    if conf.energy_payloads:
        _energy(run)
    if conf.construction_workbooks:
        _construction(run)
    if conf.tax_workbooks:
        _tax(run)
    run.parts = [tidy_rows(run.out[f"silver_{name}"]) for name in run.marks]
    gold, lake = [*DIMENSIONS, "fact", "monthly", "measures"], conf.lake
    mark = fingerprint("gold", run.marks, conf.regions, conf.data_scope, conf.measures, conf.parents, conf.indicators)
    run.step("gold", mark, lambda info: _gold(run, info), {t: f"{lake}/gold/{t}" for t in gold} | {
        "accounting": f"{lake}/quality/accounting"})
    return run.out


def _gold(run: _Run, info: dict) -> None:
    spark, conf = run.spark, run.conf
    before = previous_gold(spark, conf)
    monthly = materialize(_monthly(run, before.get("monthly")), "silver_monthly")
    regions = spark.createDataFrame([(r,) for r in conf.regions], "region string") if conf.regions \
        else monthly.select("region").distinct()
    star = build_star(monthly, regions, written=True, existing={k: before[k] for k in DIMENSIONS if k in before},
                      measures=conf.measures, parents=conf.parents, indicators=conf.indicators)
    for dim in DIMENSIONS:
        run.out[dim] = _write(getattr(star, dim), f"{conf.lake}/gold/{dim}", f"gold_{dim}", {})
    # one directory per source: a source-filtered query prunes to its files
    fact = run.out["fact"] = _write(clustered(star.fact), f"{conf.lake}/gold/fact", "gold_fact", info, ["source_key"])
    run.out["monthly"] = _write(monthly, f"{conf.lake}/gold/monthly", "gold_monthly", {})
    run.out["measures"] = _write(derive_measures(monthly, star.dim_measure), f"{conf.lake}/gold/measures",
                                 "gold_measures", {})
    _account(run, fact, star.dim_source, before.get("monthly"))


def _account(run: _Run, fact: DataFrame, dim_source: DataFrame, previous: DataFrame | None) -> None:
    """Write the accounting table; fail if a source's fact total isn't what Silver accepted (in scope)."""
    gold = fact.join(dim_source, "source_key").groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").cast("decimal(38,4)").alias("total"))
    # sums of additive measures straight from Silver, whose rows needn't meet first; the others by their exact means
    rows = apply_scope(consolidate(run.parts), "period", run.conf.data_scope)
    adds = additive(F.col("measure"), run.conf.measures)
    silver = rows.where(adds).select(*TIDY_KEY, "value").unionByName(roll_up(rows.where(~adds), TIDY_KEY, adds))
    if previous is not None:
        loaded = sorted({a[0] for a in run.accounts})
        kept = ~F.col("source").isin(loaded)
        if run.conf.data_scope not in (None, "", "full_history"):
            kept = kept | ~_in_scope(run.conf.data_scope)
        silver = silver.unionByName(previous.where(kept).select(*silver.columns))
    expected = silver.groupBy("source").agg(F.sum("value").cast("decimal(38,4)").alias("total"))
    checked = materialize(totals_vs_expected(gold.select("source", "total"), expected, ["source"], ["total"]), "totals")
    counted = run.spark.createDataFrame(run.accounts, "source string, layer string, rows bigint, total decimal(38,4)")
    table = counted.unionByName(gold.select("source", F.lit("fact").alias("layer"), "rows", "total"))
    run.out["accounting"] = _write(table, f"{run.conf.lake}/quality/accounting", "accounting", {})
    wrong = checked.where("status <> 'OK'").limit(5).collect()
    if wrong:
        raise LossError(f"fact totals differ from Silver: {wrong}")
