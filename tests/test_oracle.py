"""Every registered query against its SQL oracle (DuckDB) on the smallest
driver tables; values must match exactly, order-insensitively."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from adtrail.plans.registry import QUERIES
from tools.check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_sql_or_a_named_test():
    """Queries of the survey all have SQL; one without SQL is named in a test."""
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    folder = os.path.dirname(os.path.abspath(__file__))
    named = "".join(open(os.path.join(d, f)).read() for d, _, files in os.walk(folder) for f in files if f.endswith(".py"))
    for name in set(E.queries()) - set(E.oracle_sql()):
        module = getattr(E.queries()[name], "__module__", "").rsplit(".", 1)[-1]
        assert name in named or module in named, f"{name} has neither SQL nor a test"


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    exact, _, note = compare(got, want)
    assert exact, note


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "total_clicks", "total_impressions", "daily_ctr"]
    assert df.count() > 0
