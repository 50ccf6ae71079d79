"""The entry points work from any working directory with a plain session
(Python workers must be able to import the package)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import importlib.util, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1] + "/__spark_entry__.py")
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
assert m.entry(spark).count() == 5
for name in ("batch_inference", "generate_qa", "rouge_l", "scorer_evals"):
    assert m.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("HARNESS-OK")
'''


def test_entry_points_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="evalspark-harness-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "HARNESS-OK" in out.stdout, out.stderr[-3000:]
