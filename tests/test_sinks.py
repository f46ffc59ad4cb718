import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adtrail import versions as V
from adtrail.operators.metrics import add_key_metrics
from adtrail.session import SHUFFLE_CLEANUP, released_shuffles
from adtrail.sinks import append_batch, publish_parquet, replace_table, save_final, table_root, write_parquet
from adtrail.sources.analytics import load_analytics
from tests.conftest import ts

SCHEMA = "clicks bigint, geo string, date timestamp_ntz, platform string"
ROWS = [(40, "NO", ts("2023-11-20"), "google_ads"), (41, "PT", ts("2023-10-02"), "web_traffic"),
        (42, None, None, "google_ads")]


def test_parquet_round_trip_partitioned(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nested", "final")
    write_parquet(spark.createDataFrame(ROWS, SCHEMA), path)
    assert sorted(p for p in os.listdir(path) if p.startswith("platform=")) == [
        "platform=google_ads", "platform=web_traffic"]
    back = load_analytics(spark, path, "parquet")
    assert back.count() == 2  # the NULL-date row is dropped on load
    assert sorted(r.clicks for r in back.collect()) == [40, 41]


def test_table_round_trip_and_replace(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    replace_table(df, "t_round_trip")
    replace_table(df.limit(1), "t_round_trip")
    assert spark.table("t_round_trip").count() == 1
    back = load_analytics(spark, fmt="table", table="t_round_trip")
    assert back.count() == 1


def test_empty_table_keeps_columns(spark):
    replace_table(spark.createDataFrame([], SCHEMA), "t_empty")
    assert sorted(spark.table("t_empty").columns) == ["clicks", "date", "geo", "platform"]


def test_missing_inputs(spark, tmp_dir):
    assert load_analytics(spark, os.path.join(tmp_dir, "nothing"), "parquet") is None
    assert load_analytics(spark, fmt="table", table="no_such_table") is None
    assert load_analytics(spark, tmp_dir, "sqlite") is None


def test_append_batch(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    df = spark.createDataFrame(ROWS[:1], SCHEMA)
    append_batch(df, path)
    append_batch(df, path)
    assert spark.read.parquet(path).count() == 2


def test_save_final_dispatch(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = save_final(df, {"parquet": {"save": True, "path": os.path.join(tmp_dir, "p")},
                          "table": {"save": False, "table": "unused"}})
    assert out["format"] == "parquet"
    assert save_final(df, {"parquet": {"save": False, "path": "x"}}) is None


def test_load_empty_parquet_and_table_keep_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    empty = spark.createDataFrame([], "platform string, sessions bigint")
    empty.write.parquet(path)
    back = load_analytics(spark, path, "parquet")
    assert back is not None and back.count() == 0 and back.columns == ["platform", "sessions"]
    replace_table(empty, "t_empty_two")
    back = load_analytics(spark, fmt="table", table="t_empty_two")
    assert back.count() == 0 and back.columns == ["platform", "sessions"]


def test_loaded_date_is_timestamp(spark, tmp_dir):
    path = os.path.join(tmp_dir, "textdates")
    spark.createDataFrame([("2024-01-01", 1), ("garbage", 2)], "date string, n int").write.parquet(path)
    back = load_analytics(spark, path, "parquet")
    assert dict(back.dtypes)["date"] == "timestamp_ntz" and back.count() == 1


def test_failed_replace_keeps_old_table(spark):
    import pytest
    from pyspark.sql import functions as F
    good = spark.createDataFrame(ROWS, SCHEMA)
    replace_table(good, "t_safe")
    bad = good.withColumn("geo", F.when(F.col("clicks") == 41, F.raise_error(F.lit("boom"))).otherwise(F.col("geo")))
    with pytest.raises(Exception):
        replace_table(bad, "t_safe")
    assert spark.table("t_safe").count() == 3  # old table intact
    replace_table(good.limit(2), "t_safe")
    assert spark.table("t_safe").count() == 2


def test_partitioned_table_replace(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    replace_table(df, "t_parts", partition_by=("platform",))
    replace_table(df.limit(1), "t_parts", partition_by=("platform",))
    assert spark.table("t_parts").count() == 1


def dated(spark, days=40, per_day=25):
    """Rows over many days; one day holds a third of them, some have no date."""
    return (spark.range(days * per_day).select(
        F.when(F.col("id") % 50 == 7, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("2024-02-10")).otherwise(
            F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")), "yyyy-MM-dd"))
        .cast("timestamp_ntz").alias("date"),
        F.element_at(F.array(F.lit("google_ads"), F.lit("web_traffic")), (F.col("id") % 2 + 1).cast("int")).alias("platform"),
        F.concat(F.lit("C"), F.col("id") % 11).alias("client_id"), F.col("id").alias("clicks")))


def test_published_folder_is_swapped_by_its_pointer(spark, tmp_dir):
    root = os.path.join(tmp_dir, "data", "final")
    first = publish_parquet(dated(spark), root)
    early = V.read_current(spark, root)
    held = early.count()
    second = publish_parquet(dated(spark).limit(10), root)
    assert V.current_version(spark, root) == second and V.versions(spark, root) == [first, second]
    assert V.read_current(spark, root).count() == 10 and early.count() == held == 1000  # begun readers finish on the old
    bad = dated(spark).withColumn("clicks", F.when(F.col("clicks") == 500, F.raise_error(F.lit("boom"))).otherwise(F.col("clicks")))
    with pytest.raises(Exception):
        publish_parquet(bad, root)
    assert V.current_version(spark, root) == second and load_analytics(spark, root).count() <= 10
    third = publish_parquet(dated(spark).limit(3), root)
    assert V.versions(spark, root) == [second, third]  # the failed write and the oldest version are gone


def test_a_write_cut_before_the_pointer_changes_nothing(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "final")
    publish_parquet(dated(spark).limit(5), root)

    def die(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(V, "set_current", die)
    with pytest.raises(KeyboardInterrupt):
        publish_parquet(dated(spark), root)
    monkeypatch.undo()
    assert V.read_current(spark, root).count() == 5 and len(V.versions(spark, root)) == 2


def test_a_day_opens_few_files_and_a_hot_day_is_spread(spark, tmp_dir):
    root = os.path.join(tmp_dir, "final")
    df = dated(spark, per_day=250)
    publish_parquet(df, root, files=24)
    files = len(V.read_current(spark, root).inputFiles())
    assert files >= 24
    for day in ("2024-01-03", "2024-02-10", "2024-02-05"):
        got = load_analytics(spark, root, date_range=(day,))
        want = df.where(F.col("date") == F.lit(day).cast("timestamp_ntz"))
        assert sorted(r.clicks for r in got.collect()) == sorted(r.clicks for r in want.collect())
        opened = len(got.inputFiles())
        assert opened > 4 if day == "2024-02-10" else opened <= files // 6
    few = load_analytics(spark, root, date_range=("2024-01-05", "2024-01-08"))
    assert few.count() == df.where("date between timestamp_ntz'2024-01-05' and timestamp_ntz'2024-01-08'").count()
    assert load_analytics(spark, root, date_range=("2031-01-01",)).count() == 0
    assert load_analytics(spark, root).count() == df.where("date is not null").count()


def test_table_swap_changes_only_the_location(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    replace_table(df, "t_swap")
    early = spark.table("t_swap")
    n = early.count()
    statements = []
    spark_sql = type(spark).sql
    try:
        type(spark).sql = lambda self, q, *a, **k: (statements.append(q), spark_sql(self, q, *a, **k))[1]
        replace_table(df.limit(1), "t_swap")
    finally:
        type(spark).sql = spark_sql
    assert not [q for q in statements if "DROP" in q or "RENAME" in q] and any("SET LOCATION" in q for q in statements)
    assert spark.table("t_swap").count() == 1 and n == 3
    replace_table(df.withColumn("extra", F.lit("x")), "t_swap")  # a new column
    assert spark.table("t_swap").columns[-1] == "extra" and spark.table("t_swap").count() == 3
    replace_table(df.withColumn("clicks", F.col("clicks").cast("string")), "t_swap")  # another type: made anew
    assert dict(spark.table("t_swap").dtypes)["clicks"] == "string" and spark.table("t_swap").count() == 3
    assert len(V.versions(spark, table_root(spark, "t_swap"))) == 2


def test_second_format_is_written_from_the_first(spark, tmp_dir):
    runs = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(ROWS, SCHEMA)
    counted = spark.createDataFrame(df.rdd.map(lambda r: (runs.add(1), tuple(r))[1]), SCHEMA)
    out = save_final(counted, {"table": {"save": True, "table": "t_both"}, "parquet": {"save": True, "path": os.path.join(tmp_dir, "b")}})
    assert out["format"] == "table" and runs.value == len(ROWS)
    assert spark.table("t_both").count() == V.read_current(spark, os.path.join(tmp_dir, "b")).count() == 3


def test_second_format_is_not_sorted_again(spark, tmp_dir, monkeypatch):
    """The first format's files are in order already; a table written alone or first is still sorted."""
    from adtrail import sinks

    orders = []
    layout = sinks._layout

    def spy(df, partition_by, sort_within):
        orders.append((tuple(partition_by), tuple(sort_within)))
        return layout(df, partition_by, sort_within)

    monkeypatch.setattr(sinks, "_layout", spy)
    df = spark.sql("SELECT id, CAST(id % 3 AS string) AS platform, TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(int(id % 7)) AS date FROM range(50)")
    path = os.path.join(tmp_dir, "first")
    sinks.save_final(df, {"parquet": {"save": True, "path": path}, "table": {"save": True, "table": "t_second"}})
    assert orders == [(("platform",), ("date",)), ((), ())]
    rows = lambda t: sorted(tuple(r) for r in t.select("id", "platform", "date").toLocalIterator())
    assert rows(spark.table("t_second")) == rows(df)
    orders.clear()
    sinks.save_final(df, {"table": {"save": True, "table": "t_second"}})
    assert orders == [((), ("platform", "date"))]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def gone(spark, before):
    for _ in range(100):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_shuffle_files_go_with_each_write(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    save_final(dated(spark), {"parquet": {"save": True, "path": str(tmp_path / "p")}})
    assert gone(spark, before) and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    with pytest.raises(ValueError):
        with released_shuffles(spark):
            raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_metrics_are_not_shuffled(spark, tmp_path):
    """The metrics of a published final table are made behind the ranges, and are the same."""
    rows = [("K1", datetime(2024, 1, 1), 3, 0, 2.5, 0, 0, "n"), ("K2", datetime(2024, 1, 2), 0, 9, 0.0, 4, 1, "m"), ("K3", None, 5, 7, 1.0, 0, 2, "o")]
    facts = spark.createDataFrame(rows, "client_id string, date timestamp_ntz, clicks long, impressions long, spend_usd double, "
                                        "emails_sent long, sessions long, name string")
    final = add_key_metrics(facts).withColumn("last", F.lit(1))
    for i, with_metrics in enumerate((False, True)):
        publish_parquet(final, str(tmp_path / str(i)), partition_by=(), with_metrics=with_metrics)
    kept = [V.read_current(spark, str(tmp_path / str(i))) for i in (0, 1)]
    assert kept[0].columns == kept[1].columns == final.columns and kept[0].dtypes == kept[1].dtypes == final.dtypes
    assert sorted(map(str, kept[0].collect())) == sorted(map(str, kept[1].collect())) == sorted(map(str, final.collect()))
