import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.functions.parsing import duration_seconds, na_to_null, to_count, to_number
from adtrail.operators.cleaning import clean_source, clean_sources, enforce_types, standardize_columns


def test_google_rename_and_types(spark):
    days = ["2022-07-0%d" % d for d in range(1, 5)]
    raw = spark.createDataFrame(
        [(f"K{i}", day, str(3 * i), str(70 * i), f"{i}.5", "tablet", "SE", f"camp-{i}") for i, day in enumerate(days)],
        "client_id string, date string, clicks string, impressions string, cost_usd string, "
        "device_type string, geo string, campaign_id string")
    out = clean_source(raw, "google_ads")
    assert out.columns == ["campaign_id", "client_id", "date", "clicks", "impressions", "spend_usd",
                           "device_type", "geo", "platform"]
    types = dict(out.dtypes)
    assert [types[c] for c in ("clicks", "impressions", "spend_usd", "date")] == ["bigint", "bigint", "double", "timestamp_ntz"]
    for i, row in enumerate(out.orderBy("date").collect()):
        assert (row.platform, row.client_id, row.clicks, row.impressions, row.spend_usd) == ("google_ads", f"K{i}", 3 * i, 70 * i, i + 0.5)
        assert row.date == dt.datetime(2022, 7, i + 1)


def test_facebook_platform_becomes_detail(spark):
    raw = spark.createDataFrame(
        [("F1", "C1", "2024-01-02", "3", "40", "1.5", "instagram", "DE", "extra")],
        "fb_campaign_id string, client string, date string, clicks string, reach string, spend string, "
        "platform string, geo string, unused string")
    row = clean_source(raw, "facebook_ads").first().asDict()
    assert row["platform"] == "facebook_ads" and row["platform_detail"] == "instagram"
    assert row["campaign_id"] == "F1" and row["client_id"] == "C1" and row["impressions"] == 40
    assert "unused" not in row


def test_missing_mapped_columns_are_skipped(spark):
    raw = spark.createDataFrame([("C1", "2024-01-01")], "client_id string, date string")
    assert standardize_columns(raw, "email_campaigns").columns == ["client_id", "date", "platform"]


def test_unmapped_source_keeps_columns(spark):
    raw = spark.createDataFrame([("C1", "Acme")], "client_id string, name string")
    out = standardize_columns(raw, "clients")
    assert out.columns == ["client_id", "name", "platform"]
    assert out.first().platform == "clients"


def test_bad_values_default(spark):
    raw = spark.createDataFrame(
        [("C1", "not a date", "12.9", "x", "oops")],
        "client_id string, date string, clicks string, sessions string, bounce_rate string")
    row = enforce_types(raw).first()
    assert row.date is None
    assert row.clicks == 12  # fraction truncated
    assert row.sessions == 0  # unparseable count -> 0
    assert row.bounce_rate is None  # unparseable rate stays NULL until the union fills it


def test_duration_seconds_vectors(spark):
    vals = ["01:02:03", "05:30", "90", "a:b", "1:2:3:4", "00:01:30.5", None]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    got = [r[0] for r in df.select(duration_seconds("d")).collect()]
    assert got == [3723, 330, 0, 0, 0, 0, 0]


def test_web_duration_replaced_and_appended(spark):
    raw = spark.createDataFrame([("C1", "2024-01-01", "10", "5", "0.5", "0:01:40")],
                                "client_id string, date string, pageviews string, sessions string, "
                                "bounce_rate string, avg_session_duration string")
    out = clean_source(raw, "web_traffic")
    assert out.columns[-1] == "avg_session_duration_seconds"
    assert "avg_session_duration_str" not in out.columns
    assert out.first().avg_session_duration_seconds == 100


def test_numbers_nan_inf_to_null(spark):
    df = spark.createDataFrame([("NaN",), ("inf",), ("-Infinity",), ("2.5",), (None,)], "x string")
    got = [r[0] for r in df.select(to_number("x")).collect()]
    assert got == [None, None, None, 2.5, None]
    counts = [r[0] for r in df.select(to_count("x", T.StringType())).collect()]
    assert counts == [0, 0, 0, 2, 0]


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), (" null ",), ("value",), ("",)], "x string")
    assert [r[0] for r in df.select(na_to_null("x")).collect()] == [None, None, None, "value", None]


def test_clean_sources_drops_none_and_passes_blank(spark):
    blank = spark.createDataFrame([], T.StructType([]))
    good = spark.createDataFrame([("C1", "2024-01-01", "ch", "1.0")],
                                 "client_id string, date string, channel string, attributed_revenue string")
    out = clean_sources({"revenue": good, "google_ads": None, "web_traffic": blank})
    assert set(out) == {"revenue", "web_traffic"}
    assert out["web_traffic"].columns == []
    assert out["revenue"].select(F.col("attributed_revenue_usd")).first()[0] == 1.0


def test_garbage_never_fails_the_job(spark):
    df = spark.createDataFrame([("99999999999999999:0:0", "1e300", "9.9e18")], "d string, x string, c string")
    r = df.select(duration_seconds("d").alias("d"), to_number("x").alias("x"),
                  to_count("c", T.StringType()).alias("c")).first()
    assert r.d == 0 and r.x == 1e300 and r.c == 0


def test_events_become_web_traffic_rows(spark):
    from adtrail.sources.bindings import web_projection_from_events
    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 5, 13, 45, 12, 500), 7, "view", 65.9, "{}"),
         (2, dt.datetime(2024, 1, 5, 23, 59, 59), 7, "error", 0.5, "{}")],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    rows = clean_source(web_projection_from_events(ev), "web_traffic").orderBy("bounce_rate").collect()
    assert [r.date for r in rows] == [dt.datetime(2024, 1, 5)] * 2  # truncated to the day
    assert [(r.pageviews, r.sessions, r.avg_session_duration_seconds) for r in rows] == [(1, 1, 65), (0, 0, 0)]
