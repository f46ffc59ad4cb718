"""Rules a clean, typed input never exercises."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adtrail.functions.metrics import money_sum
from adtrail.operators.explore import apply_filters, preview
from adtrail.sinks import replace_table
from adtrail.sources.files import read_csv_source
from adtrail.streaming.refresh import refresh
from adtrail import schemas as S


def test_small_amounts_are_not_cut(spark):
    df = spark.range(100_000).select(F.lit(0.00004).alias("x"), F.lit(4e-11).alias("y"), F.lit(1e35).alias("z"))
    got = df.agg(money_sum("x").alias("x"), money_sum("y").alias("y"), money_sum("z").alias("z")).first()
    assert got.x == 4.0 and got.y == pytest.approx(4e-6) and got.z == pytest.approx(1e40)
    assert spark.range(0).select(F.lit(1.0).alias("x")).agg(money_sum("x")).first()[0] is None


def test_money_keeps_decimal_sums_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    assert df.agg(money_sum("x")).first()[0] == 1.0


def test_replace_after_a_failed_write_with_files_left(spark):
    good = spark.range(3)
    replace_table(good, "t_left", sort_within=())
    where = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    os.makedirs(f"{where}/t_left__staging", exist_ok=True)
    open(f"{where}/t_left__staging/part-0.parquet", "w").close()
    with pytest.raises(Exception):
        replace_table(good.select(F.raise_error(F.lit("boom")).alias("id")), "t_left", sort_within=())
    assert spark.table("t_left").count() == 3
    replace_table(good.limit(2), "t_left", sort_within=())
    assert spark.table("t_left").count() == 2


def test_datetime_filter_does_not_depend_on_the_process_zone(spark, monkeypatch):
    import time
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS date")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        assert apply_filters(df, date_range=(dt.datetime(2024, 1, 1),)).count() == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_number_text_shapes(spark):
    from adtrail.functions.parsing import number_sql
    values = ["10d", "10f", "0x10p1", "1e3", " 2.5 ", ".5", "-7", "abc", "1,0"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.selectExpr(number_sql("x")).collect()] == [None, None, None, 1000.0, 2.5, 0.5, -7.0, None, None]


def test_mixed_csv_headers_go_by_name(spark, tmp_dir):
    cols = S.REQUIRED_COLUMNS[S.REVENUE]
    for name, order in (("a", cols), ("b", cols[::-1])):
        value = {"client_id": "7", "date": "2024-01-01", "channel": name, "attributed_revenue": "2.5"}
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(",".join(order) + "\n" + ",".join(value[c] for c in order) + "\n")
    rows = read_csv_source(spark, tmp_dir, S.REVENUE).collect()
    assert sorted((r.client_id, str(r.date.date()), r.channel, r.attributed_revenue) for r in rows) == [
        ("7", "2024-01-01", "a", 2.5), ("7", "2024-01-01", "b", 2.5)]



def test_refresh_of_some_sources_leaves_the_table_alone(spark, tmp_dir):
    out = f"{tmp_dir}/final"
    spark.range(2).write.parquet(out)
    landing = {S.CLIENTS: f"{tmp_dir}/in_clients"}
    os.makedirs(landing[S.CLIENTS])
    with open(f"{landing[S.CLIENTS]}/clients.csv", "w") as f:
        f.write("client_id,name,industry,account_manager,signup_date\nk1,North,Toys,Sam,2024-02-02\n")
    assert refresh(spark, landing, f"{tmp_dir}/work", {"parquet": {"save": True, "path": out}}) is None
    assert spark.read.parquet(out).count() == 2


def test_preview_reads_first_rows(spark):
    assert preview(spark.range(100)).count() == 5
