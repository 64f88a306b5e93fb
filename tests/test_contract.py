"""The driver contract from a fresh process whose working directory is not
the repository: Python workers must not need this package on their path."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("se", "{REPO}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
assert len(m.entry(spark).collect()) == 4599
assert len(m.queries()["ratio_pairs"](spark, "/root/testdata/sf0.001").collect()) > 0
print("OK")
"""


def test_contract_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="twinsift-cwd-"), env=env,
        capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-2000:]
