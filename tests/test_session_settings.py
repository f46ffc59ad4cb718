"""Results do not depend on the session's ANSI mode or time zone (run in a
fresh Spark process, since time zones are bound when a plan is analysed)."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_results_independent_of_ansi_and_time_zone():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "check_session_settings.py"), SF],
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.split(" ")[0]]
    assert len(lines) == 10, out.stdout + out.stderr[-2000:]
    assert all(" EXACT" in ln for ln in lines), out.stdout
