"""The driver contract works from any working directory with a plain session:
the package reaches the executors' Python workers (pandas UDF queries)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
spec = importlib.util.spec_from_file_location("entry_mod", "{REPO}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
q = m.queries()
assert set(m.oracle_sql()) <= set(q)
for name in ["knn_within_class", "parse_list_tolerant", "batch_inference"]:
    print(name, q[name](spark, "/root/testdata/sf0.001").count())
print("entry", m.entry(spark).count())
"""


def test_entry_runs_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="penmark-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                       text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    lines = dict(line.split() for line in r.stdout.splitlines() if line.count(" ") == 1)
    assert int(lines["knn_within_class"]) > 0 and int(lines["entry"]) > 0
