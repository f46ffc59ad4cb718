from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adtrail.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="adtrail-tests-")
    s = build_session("local[4]", app_name="adtrail-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
    })
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="adtrail-t-")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)
