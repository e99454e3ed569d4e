"""The driver's path: a bare SparkSession in another working directory calls the entry points."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4") \\
    .config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
rows = E.entry(spark).collect()
assert 0 < len(rows) <= 3, rows
n = E.queries()["g15_sequential_values"](spark, "/root/testdata/sf0.001").count()
assert n > 0, n
print("OK", len(rows), n)
"""


def test_entry_from_bare_session_elsewhere():
    cwd = tempfile.mkdtemp(prefix="postlake-entry-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "OK" in out.stdout
