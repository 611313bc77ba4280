"""The driver imports ``__spark_entry__`` from its own working directory with
its own session: Python worker processes must still find the package."""

import os
import subprocess
import sys

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spec = importlib.util.spec_from_file_location("spark_entry", {entry!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
print("rows", m.queries()["scan_csv_strings"](spark, "/root/testdata/sf0.001").count(),
      m.queries()["header_labels"](spark, "/root/testdata/sf0.001").count() > 0)
"""


def test_queries_from_another_directory(tmp_path):
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(entry=entry)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "rows 150 True" in out.stdout, out.stderr[-2000:]
