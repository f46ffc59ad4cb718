import datetime as dt

from adtrail.operators import explore as X
from adtrail.operators.ids import campaign_counts, campaigns_per_client, next_client_number
from tests.conftest import ts
from tests.test_reports import FINAL_SCHEMA, RECS, ROWS, brute_group


def final(spark):
    return spark.createDataFrame(ROWS, FINAL_SCHEMA)


def brute_filter(client=None, platform=None, lo=None, hi=None):
    return [r for r in RECS if (client is None or r["client_id"] == client)
            and (platform is None or r["platform"] == platform)
            and (lo is None or r["date"] >= lo) and (hi is None or r["date"] <= hi)]


def test_filters(spark):
    df = final(spark)
    assert X.apply_filters(df).count() == len(RECS)
    assert X.apply_filters(df, client="K7").count() == len(brute_filter(client="K7"))
    assert X.apply_filters(df, platform="google_ads").count() == len(brute_filter(platform="google_ads"))
    assert X.apply_filters(df, date_range=("2024-03-01", "2024-03-02")).count() == \
        len(brute_filter(lo=ts("2024-03-01"), hi=ts("2024-03-02")))
    day = ts("2024-03-02")
    assert X.apply_filters(df, date_range=(dt.date(2024, 3, 2),)).count() == len(brute_filter(lo=day, hi=day))
    # any other number of dates means no date filter
    assert X.apply_filters(df, date_range=("2024-03-01", "2024-03-02", "2024-03-03")).count() == len(RECS)
    both = X.apply_filters(df, client="K7", platform="facebook_ads", date_range=("2024-03-03", "2024-03-03"))
    assert both.count() == len(brute_filter("K7", "facebook_ads", ts("2024-03-03"), ts("2024-03-03"))) == 1


def test_filters_without_match_are_empty(spark):
    df = final(spark)
    assert X.apply_filters(df, client="NOPE").count() == 0
    assert X.apply_filters(df, platform="tiktok").count() == 0
    assert X.apply_filters(df, date_range=("2030-01-01", "2030-12-31")).count() == 0


def test_key_totals(spark):
    r = X.key_totals(final(spark)).first()
    total = lambda c: sum(x[c] for x in RECS)
    assert (r.total_clicks, r.total_impressions, r.total_sessions, r.total_emails_sent) == (
        total("clicks"), total("impressions"), total("sessions"), total("emails_sent"))
    assert r.total_spend_usd == total("spend_usd")
    assert r.total_attributed_revenue_usd == total("attributed_revenue_from_source_usd")


def test_key_totals_absent_columns_and_empty(spark):
    df = spark.createDataFrame([("C1",)], "client_id string")
    assert tuple(X.key_totals(df).first()) == (0.0, 0, 0, 0, 0, 0.0)
    assert tuple(X.key_totals(final(spark).limit(0)).first()) == (0.0, 0, 0, 0, 0, 0.0)


def test_format_key_totals(spark):
    df = spark.createDataFrame([(1234567.891, 1234567, 0, 0, 0, 0.5)],
                               "total_spend_usd double, total_clicks bigint, total_impressions bigint, "
                               "total_sessions bigint, total_emails_sent bigint, total_attributed_revenue_usd double")
    r = X.format_key_totals(df).first()
    assert (r.total_spend_usd, r.total_clicks, r.total_attributed_revenue_usd) == ("$1,234,567.89", "1,234,567", "$0.50")


def test_chart_aggregates(spark):
    df = final(spark)
    spend = {k[0]: v["spend_usd"] for k, v in brute_group(["platform"], ["spend_usd"]).items()}
    assert dict(X.spend_by_platform(df).collect()) == spend
    clicks = {k[0]: v["clicks"] for k, v in brute_group(["date"], ["clicks"]).items()}
    assert {r.date: r.clicks for r in X.clicks_over_time(df).collect()} == clicks
    ads = [r for r in RECS if r["platform"] in ("google_ads", "facebook_ads")]
    want = brute_group(["platform"], ["clicks", "impressions"], ads)
    got = {r.platform: r.aggregate_ctr for r in X.ctr_by_platform(df).collect()}
    assert got == {k[0]: v["clicks"] / v["impressions"] * 100 for k, v in want.items()}
    assert X.web_daily(df) is None  # no pageviews column: chart skipped
    web = {r.date: r.total_sessions for r in X.web_daily(df.withColumn("pageviews", df.sessions * 2)).collect()}
    webs = [r for r in RECS if r["platform"] == "web_traffic"]
    assert web == {k[0]: v["sessions"] for k, v in brute_group(["date"], ["sessions"], webs).items()}
    assert X.spend_by_platform(df.drop("spend_usd")) is None
    rev = {(r.date, r.platform): r.attributed_revenue_from_source_usd for r in X.revenue_over_time(df).collect()}
    want_rev = {k: v["attributed_revenue_from_source_usd"]
                for k, v in brute_group(["date", "platform"], ["attributed_revenue_from_source_usd"]).items()
                if v["attributed_revenue_from_source_usd"] > 0}
    assert rev == want_rev


def test_date_bounds_and_distincts(spark):
    df = final(spark)
    b = X.date_bounds(df).first()
    assert (b.min_label, b.max_label) == ("2024-03-01", "2024-03-03")
    assert [r[0] for r in X.distinct_values(df, "client_id").collect()] == sorted({r["client_id"] for r in RECS})
    assert [r[0] for r in X.selector_options(df, "platform").collect()] == \
        ["All"] + sorted({r["platform"] for r in RECS})


def test_preview_is_ordered_top_five(spark):
    rows = X.preview(final(spark), ordered=True).collect()
    assert len(rows) == 5
    assert [(r.date, r.client_id) for r in rows] == sorted((r["date"], r["client_id"]) for r in RECS)[:5]


def test_next_client_number(spark):
    ok = spark.createDataFrame([("C204",), ("C219",), ("C207",)], "client_id string")
    assert next_client_number(ok).first()[0] == 220
    bad = spark.createDataFrame([("C204",), ("X-9",)], "client_id string")
    assert next_client_number(bad).first()[0] == 101
    assert next_client_number(ok.limit(0)).first()[0] == 101


def test_campaigns_per_client(spark):
    df = final(spark)
    want = {(r["client_id"], r["platform"], r["campaign_id"]) for r in RECS
            if r["platform"] in ("google_ads", "facebook_ads", "email_campaigns") and r["campaign_id"]}
    assert {tuple(r) for r in campaigns_per_client(df).collect()} == want
    counts = {(r.client_id, r.platform): r.campaigns for r in campaign_counts(df).collect()}
    assert counts == {(c, p): sum(1 for w in want if w[:2] == (c, p)) for c, p, _ in want}


def test_dashboard_views(spark):
    views = X.dashboard_views(final(spark), client="K7", date_range=("2024-03-01", "2024-03-02"))
    assert views["web_daily"] is None  # the fixture has no pageviews column
    assert views["client_options"].first()[0] == "All"
    k7 = brute_filter(client="K7", lo=ts("2024-03-01"), hi=ts("2024-03-02"))
    assert views["key_totals"].first().total_clicks == sum(r["clicks"] for r in k7)
    assert views["preview"].count() == min(5, len(k7))
    assert {r.platform for r in views["clicks_by_platform"].collect()} == {r["platform"] for r in k7}


def test_unreadable_filter_date_is_an_error(spark):
    import pytest
    for bad in (("soon",), ("2024-03-01", "2024-13-01")):
        with pytest.raises(ValueError):
            X.apply_filters(final(spark), date_range=bad)


def test_new_clients_get_numbers_without_gaps(spark):
    from pyspark.sql import functions as F
    from adtrail.operators.ids import number_new_clients
    held = spark.createDataFrame([("C205",), ("C219",)], "client_id string")
    batch = spark.range(500, numPartitions=7).select(F.lit("x").alias("client_id"), F.format_string("n%04d", 499 - F.col("id")).alias("name"))
    got = {r.name: r.client_id for r in number_new_clients(batch, held, ["name"]).collect()}
    assert got == {f"n{i:04d}": f"C{220 + i}" for i in range(500)}
    assert number_new_clients(batch.limit(0), held, ["name"]).count() == 0
    assert [r.client_id for r in number_new_clients(batch.limit(1), held.limit(0), ["name"]).collect()] == ["C101"]
