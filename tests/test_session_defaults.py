"""Settings a launcher gives win over the library's defaults."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
from adtrail.session import build_session
s = build_session("local[1]")
print("GOT", s.conf.get("spark.sql.files.maxPartitionBytes"), s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
s.stop()
"""


def test_submitted_settings_win():
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.files.maxPartitionBytes=64m pyspark-shell",
           "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT 64m 128m" in out
