"""Python workers need no installed copy of the package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from taskspark.functions.alignment import align_hybrid
from taskspark.operators.outliers import drop_outliers
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
pairs = spark.createDataFrame([(["A", "B"], ["A", "B"])], "a array<string>, b array<string>")
assert pairs.select(align_hybrid(F.col("a"), F.col("b")).score.alias("s")).first()["s"] == 1.0
rows = spark.range(50).select(F.col("id").alias("Id"), F.lit(1.0).alias("x"))
assert drop_outliers(rows, ["x"]).count() == 50
print("whole")
"""


def test_workers_elsewhere(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(Path(__file__).resolve().parent.parent)))
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert "whole" in run.stdout, run.stderr[-2000:]
