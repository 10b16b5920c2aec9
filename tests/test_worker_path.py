"""Python that runs on executors (scorer, shard reader/writer, first-line sniff) must not
need the package on the workers' path: run those queries from a process started outside
the repository, in a session with default settings."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
for k in ("arrow_shards", "scan_discovery", "score_with_retry"):
    print(k, len(E.queries()[k](spark, "/root/testdata/sf0.001").collect()))
spark.stop()
"""


def test_executor_code_needs_no_package_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    counts = dict(line.split() for line in out.stdout.splitlines() if line.split()[0] in ("arrow_shards", "scan_discovery", "score_with_retry"))
    assert set(counts) == {"arrow_shards", "scan_discovery", "score_with_retry"} and all(int(v) > 0 for v in counts.values())
