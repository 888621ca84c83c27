"""The entry module must import in a fresh process without a session, also when
PySpark itself is loaded from its zip (as spark-submit does)."""

import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 90 and set(o) <= set(q); print(len(q))"


def test_imports_without_session_from_zip():
    home = os.path.dirname(pyspark.__file__)
    zips = [os.path.join(home, "python", "lib", n) for n in ("pyspark.zip",)]
    path = os.pathsep.join([z for z in zips if os.path.exists(z)] + [ROOT])
    out = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, env=os.environ | {"PYTHONPATH": path},
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
