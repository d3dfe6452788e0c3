"""The UDF code travels with the job: a session started elsewhere, whose Python workers cannot
import the package, still runs the XML path."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from accmine.operators.parse import parse_articles
df = spark.createDataFrame([("f", '<article a="1"><article-id pub-id-type="pmc">PMC9</article-id><body>x</body></article>')],
                           "source_file string, xml string")
print("RESULT", [tuple(r) for r in parse_articles(df, partitions=0).select("ok", "pmc_id").collect()])
"""


def test_udf_runs_without_package_on_workers():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "RESULT [(True, 'PMC9')]" in out.stdout, out.stderr[-2000:]


ENTRY_SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("RESULT", m.entry(spark).count() > 0, len(m.queries()), len(m.oracle_sql()))
"""


def test_entry_loads_by_path_from_elsewhere():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", ENTRY_SCRIPT], cwd=tempfile.mkdtemp(), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "RESULT True" in out.stdout, out.stderr[-2000:]
