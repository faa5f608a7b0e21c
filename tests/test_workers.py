"""Executors that cannot import this package still run the functions it sends them."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, sys.argv[1])
from orderlake import registry
for name in ("model_labels", "encode_texts", "load_rejects"):
    print(name, registry.QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_functions_travel_without_the_package(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "model_labels 196" in done.stdout and "encode_texts 185" in done.stdout, done.stderr[-2000:]
