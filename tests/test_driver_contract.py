"""The package must work when imported from elsewhere (as the driver does): Python workers
get its helpers by value, not by import."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
n = E.queries()["seed_sequences"](spark, "/root/testdata/sf0.001").count()
m = E.queries()["homology_search"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n, m)
"""


def test_arrow_stages_run_from_a_foreign_working_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=900)
    assert "ROWS" in out.stdout, out.stderr[-3000:]
    n, m = map(int, out.stdout.split("ROWS")[1].split())
    assert n > 0 and m > 0
