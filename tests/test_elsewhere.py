"""The driver contract, from a working directory that is not the repository."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {path!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
for _ in range(2):
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "2").getOrCreate())
    rows = entry.entry(spark).collect()
    assert rows and any(r["error"] is None for r in rows)
    spark.stop()
assert set(entry.oracle_sql()) <= set(entry.queries())
print("fine", len(rows))
"""


def test_entry_from_another_directory(tmp_path):
    script = SCRIPT.format(path=os.path.join(ROOT, "__spark_entry__.py"))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment,
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.startswith("fine")
