"""Every query where only the driver has the package: workers get all they need by value."""

import os
import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[2]
RUN = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        try:
            print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
        except Exception as error:
            print(name, "failed:", str(error)[-300:], flush=True)
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", RUN.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    lines = [l.split(" ", 1) for l in run.stdout.splitlines() if l.startswith(("op", "pipeline"))]
    assert len(lines) == 14, run.stderr[-2000:]
    assert all(rest.isdigit() for _, rest in lines), lines
