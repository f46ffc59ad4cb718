"""The plan properties the scale design relies on, pinned so a change
cannot silently lose them."""

import os
import re

import pyarrow.parquet as pq
import pytest

from adtrail.operators import explore as X
from adtrail.plans import stored
from adtrail.plans.registry import QUERIES, final_table
from adtrail.sinks import write_parquet
from adtrail.sources.analytics import load_analytics

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unused_revenue_join_and_branches_are_dropped(spark):
    plan = optimized(QUERIES["ctr_trends"](spark, SF))
    assert "_rev_client_id" not in plan  # no revenue column read -> no revenue join
    flags = set(re.findall(r"l_returnflag#\d+ = ([A-Z])", plan))
    assert flags == {"N", "R"}  # only the two ad-platform branches are scanned


def test_revenue_is_aggregated_and_joined_once(spark):
    plan = optimized(QUERIES["attribution"](spark, SF))
    joins = [ln for ln in plan.splitlines() if "Join LeftOuter" in ln and "_rev_client_id" in ln]
    assert len(joins) == 1  # the four mapped branches together; the revenue rows never join
    assert plan.count("Aggregate [client_id") == 1  # the other aggregate is the nation lookup


def test_written_files_are_in_date_order(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ordered")
    write_parquet(final_table(spark, SF), path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) >= 5
    for f in files:
        dates = pq.read_table(f, columns=["date"])["date"].to_pylist()
        assert dates == sorted(dates)


def test_customer_scan_reads_only_needed_columns(spark):
    df = QUERIES["ctr_trends"](spark, SF)
    scans = [ln for ln in physical(df).splitlines() if "FileScan" in ln and "c_custkey" in ln]
    assert scans and all("c_name" not in s and "c_mktsegment" not in s for s in scans)


def test_written_table_prunes_partitions_and_pushes_filters(spark, tmp_dir):
    path = os.path.join(tmp_dir, "final")
    write_parquet(final_table(spark, SF), path)
    t = load_analytics(spark, path)
    df = X.apply_filters(t, client="C41", platform="google_ads", date_range=("1997-01-01", "1997-12-31"))
    plan = physical(df)
    assert "PartitionFilters: [isnotnull(platform" in plan and "(platform" in plan
    assert "EqualTo(client_id,C41)" in plan and "GreaterThanOrEqual(date" in plan


def test_lift_shuffles_partial_aggregates(spark):
    plan = physical(QUERIES["channel_lift"](spark, SF))
    assert "partial_sum" in plan  # map-side combine before the platform shuffle


def test_wide_rows_are_not_sorted_for_the_revenue_join(spark):
    """Its result is range partitioned, which runs the join twice; a sort there spilled twice."""
    joins = [ln for ln in physical(QUERIES["attribution"](spark, SF)).splitlines() if "Join" in ln and "_rev_client_id" in ln]
    assert joins and all("ShuffledHashJoin" in ln and "BuildRight" in ln for ln in joins)


def test_published_ranges_follow_the_sessions_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, ranges in ((8, 32), (200, 200)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert stored._ranges(spark) == ranges
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
