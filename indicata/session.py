"""Session settings shared by every job.

The settings here are the ones the engine relies on for correct results
(UTC, ANSI casts, dynamic partition overwrite) plus AQE so that shuffle
partition counts, join strategies and skewed partitions are re-planned from
runtime statistics instead of fixed guesses.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine depends on; a cluster session gets them via ``configure``.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size shuffle partitions by data volume (advisory 64 MB), not by core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a partition value is the text that was written ('001' stays '001')
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows may be whole documents: what a task holds outside the heap, in the JVM and in Python, follows this
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1500",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine needs to an existing session and
    make the package importable in the session's Python workers."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (what
    ``--py-files`` does), once per application.  Needed by the tasks that run
    Python (the workbook decode); the driver's ``sys.path`` does not reach
    worker processes."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context to ship through
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(tempfile.mkdtemp(prefix="indicata-pkg-"), "indicata.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "indicata") -> SparkSession:
    """A local session for tests and the bench (no UI, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("INDICATA_DRIVER_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is used as is.  Only when nothing is configured and the master is
    local (tests, a laptop) a fresh local folder is created; on a cluster that
    would be another folder on every machine, so it fails instead.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the conf is visible
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc is not None and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="indicata-ckpt-")
    if sc is None:
        return current
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location for intermediate tables under the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/indicata-scratch/{name}-{uuid.uuid4().hex}"
