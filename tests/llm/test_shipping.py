"""The operators run where workers have no copy of the package."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from taskspark.llm import queries
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g") \\
    .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "4").getOrCreate()
for name in ("op5_decontamination", "op7_language_id", "op8_secrets", "op9_licenses", "op11_warc", "op12_vector_codes", "op13_collocations"):
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count())
print("whole")
"""


def test_workers_elsewhere(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(Path(__file__).resolve().parents[2])))
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=400)
    assert "whole" in run.stdout, run.stderr[-2000:]
