import glob
import os

import pandas as pd
import pytest

from adtrail import schemas as S
from adtrail.operators import reports as R
from adtrail.operators.lift import channel_lift, with_conversion_flag
from adtrail.operators.summary import KEY_SETS, LIFT, available_reports, report_frames, summarize_reports
from adtrail.plans.batch import generate_summary_reports
from tests.conftest import ts

FINAL_SCHEMA = ("client_id string, date timestamp_ntz, platform string, campaign_id string, clicks bigint, "
                "impressions bigint, spend_usd double, emails_sent bigint, sessions bigint, name string, "
                "industry string, ctr double, attributed_revenue_from_source_usd double")

CHANNEL_CYCLE = ["web_traffic", "facebook_ads", "email_campaigns", "google_ads", "facebook_ads"]


def touchpoints(n=19):
    """Rows by rule: channels, clients and days go round in cycles of 5, 4 and 3; every third
    campaign has no id, and every sixth ad no impressions."""
    rows = []
    for i in range(n):
        platform, client = CHANNEL_CYCLE[i % 5], f"K{5 + i % 4}"
        ad, mail, web = platform.endswith("_ads"), platform == "email_campaigns", platform == "web_traffic"
        clicks = 11 + 3 * i if ad or mail else 0
        shown = 40 * clicks if ad and i % 6 else 0
        rows.append((client, ts(f"2024-03-0{1 + i % 3}"), platform, None if web or i % 3 == 1 else f"{platform[0]}-{i % 4}",
                     clicks, shown, clicks * 0.25 if ad else 0.0, 100 * i if mail else 0, 7 * i if web else 0,
                     f"Client {client}", ["Travel", "Energy", "Media"][i % 3], 2.5 if shown else 0.0, 12.5 * (i % 4)))
    return rows


ROWS = touchpoints()
COLS = [c.split()[0] for c in FINAL_SCHEMA.split(", ")]
RECS = [dict(zip(COLS, r)) for r in ROWS]


def brute_group(keys, measures, rows=RECS):
    """Pure-Python group-by over the fixture: NULL keys dropped, sums."""
    out = {}
    for r in rows:
        k = tuple(r[c] for c in keys)
        if any(v is None for v in k):
            continue
        acc = out.setdefault(k, {m: 0 for m in measures})
        for m in measures:
            acc[m] += r[m]
    return out


@pytest.fixture
def final(spark):
    return spark.createDataFrame(ROWS, FINAL_SCHEMA)


def to_pd(df, keys):
    return df.toPandas().sort_values(keys).reset_index(drop=True)


def test_daily_client_spend(final):
    got = {(r.date, r.client_id): r.spend_usd for r in R.daily_client_spend(final).collect()}
    want = {k: v["spend_usd"] for k, v in brute_group(["date", "client_id"], ["spend_usd"]).items()}
    assert R.daily_client_spend(final).columns == ["date", "client_id", "spend_usd"]
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_clicks_by_platform(final):
    got = dict(R.clicks_by_platform(final).collect())
    assert got == {k[0]: v["clicks"] for k, v in brute_group(["platform"], ["clicks"]).items()}


def test_ctr_trends_ratio_of_sums(final):
    ads = [r for r in RECS if r["platform"] in ("google_ads", "facebook_ads")]
    want = brute_group(["date"], ["clicks", "impressions"], ads)
    got = {r.date: r for r in R.ctr_trends(final).collect()}
    assert got.keys() == {k[0] for k in want}
    for (d,), v in want.items():
        row = got[d]
        assert (row.total_clicks, row.total_impressions) == (v["clicks"], v["impressions"])
        assert row.daily_ctr == (v["clicks"] / v["impressions"] * 100 if v["impressions"] > 0 else 0.0)


def test_campaign_summary_drops_null_campaign(final):
    got = {(r.client_id, r.campaign_id): (r.total_spend, r.total_clicks, r.total_impressions)
           for r in R.campaign_summary(final).collect()}
    want = brute_group(["client_id", "campaign_id"], ["spend_usd", "clicks", "impressions"])
    assert R.campaign_summary(final).columns == [
        "client_id", "campaign_id", "total_spend", "total_clicks", "total_impressions"]
    assert got.keys() == want.keys() and not any(k[1] is None for k in got)
    for k, v in want.items():
        assert got[k][0] == pytest.approx(v["spend_usd"]) and got[k][1:] == (v["clicks"], v["impressions"])


def test_reports_none_when_columns_missing(spark):
    df = spark.createDataFrame([("C1", ts("2024-01-01"), "google_ads", 1.0)],
                               "client_id string, date timestamp_ntz, platform string, spend_usd double")
    assert R.daily_client_spend(df) is not None
    assert R.clicks_by_platform(df) is None and R.ctr_trends(df) is None and R.campaign_summary(df) is None


def _read_csv_dir(path):
    parts = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    return pd.concat([pd.read_csv(p) for p in parts], ignore_index=True)


def test_generate_summary_reports_files(spark, final, tmp_dir):
    src = os.path.join(tmp_dir, "final")
    final.write.parquet(src)
    out = os.path.join(tmp_dir, "reports")
    written = generate_summary_reports(spark, out, data_path=src, fmt="parquet")
    assert written == list(R.REPORTS)
    spend = _read_csv_dir(os.path.join(out, "daily_client_spend_report"))
    assert spend.spend_usd.sum() == pytest.approx(sum(r["spend_usd"] for r in RECS))
    clicks = _read_csv_dir(os.path.join(out, "total_clicks_by_platform_report"))
    assert list(clicks.platform) == sorted(clicks.platform)  # written in key order


def test_generate_summary_reports_empty(spark, final, tmp_dir):
    src = os.path.join(tmp_dir, "empty")
    final.limit(0).write.parquet(src)
    out = os.path.join(tmp_dir, "reports")
    assert generate_summary_reports(spark, out, data_path=src) == []
    assert not os.path.exists(out) or os.listdir(out) == []


def test_reports_skip_when_inputs_missing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "few")
    spark.createDataFrame([("K7", ts("2024-03-01"), "google_ads", 12.75), ("K8", ts("2024-03-01"),
                           "facebook_ads", 8.0)],
                          "client_id string, date timestamp_ntz, platform string, spend_usd double").write.parquet(src)
    out = os.path.join(tmp_dir, "reports")
    assert generate_summary_reports(spark, out, data_path=src) == ["daily_client_spend_report"]


def test_channel_lift(final):
    rows = channel_lift(final).collect()
    per = brute_group(["platform"], ["attributed_revenue_from_source_usd", "spend_usd", "clicks", "impressions"])
    n = {p: sum(1 for r in RECS if r["platform"] == p) for (p,) in per}
    rpt = {p: v["attributed_revenue_from_source_usd"] / n[p] for (p,), v in per.items()}
    assert [r.platform for r in rows] == sorted(rpt, key=lambda p: (-rpt[p], p))
    for r in rows:
        v = per[(r.platform,)]
        assert r.total_touchpoints == n[r.platform]
        assert r.total_attributed_revenue == pytest.approx(v["attributed_revenue_from_source_usd"])
        assert r.revenue_per_touchpoint == pytest.approx(rpt[r.platform])
        spend = v["spend_usd"]
        want_roi = (v["attributed_revenue_from_source_usd"] - spend) / spend * 100 if spend > 0 else 0.0
        assert r.attributed_roi == pytest.approx(want_roi)
    web = next(r for r in rows if r.platform == "web_traffic")
    assert web.attributed_roi == 0.0  # zero spend -> 0, not an error


def test_channel_lift_missing_columns(final):
    assert channel_lift(final, "no_such_column") is None
    assert channel_lift(final.drop("platform")) is None


def test_conversion_flag(final):
    flags = [r.is_converted for r in with_conversion_flag(final).collect()]
    assert flags.count(True) == sum(1 for r in RECS if r["attributed_revenue_from_source_usd"] > 0)


def test_reconciliation_between_reports(final):
    ctr = R.ctr_trends(final).agg({"total_clicks": "sum"}).first()[0]
    clicks = dict(R.clicks_by_platform(final).collect())
    assert ctr == clicks["google_ads"] + clicks["facebook_ads"]
    lift = {r.platform: r for r in channel_lift(final).collect()}
    spend = R.daily_client_spend(final).agg({"spend_usd": "sum"}).first()[0]
    assert spend == pytest.approx(sum(r.total_spend for r in lift.values()))
    assert S.ATTRIBUTED_REVENUE_COL in final.columns


def test_platform_report_is_one_file(spark, final, tmp_dir):
    src = os.path.join(tmp_dir, "final")
    final.write.parquet(src)
    out = os.path.join(tmp_dir, "reports")
    generate_summary_reports(spark, out, data_path=src)
    parts = glob.glob(os.path.join(out, "total_clicks_by_platform_report", "part-*.csv"))
    assert len(parts) == 1  # at most one row per platform: a single ordered file


def test_one_pass_gives_the_single_reports(spark, final, tmp_dir):
    src = os.path.join(tmp_dir, "final")
    final.write.parquet(src)
    df = spark.read.parquet(src)
    names = available_reports(df)
    assert names == list(KEY_SETS)
    summary = summarize_reports(df)
    assert summary._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    single = {n: build(df) for n, (build, _, _) in R.REPORTS.items()} | {LIFT: channel_lift(df)}
    for name, got in report_frames(summary, names).items():
        assert got.columns == single[name].columns
        assert sorted(map(str, got.collect())) == sorted(map(str, single[name].collect())), name


def test_one_pass_skips_what_is_missing(spark, final):
    few = final.drop("clicks", "campaign_id")
    assert available_reports(few) == ["daily_client_spend_report"]
    got = report_frames(summarize_reports(few), ["daily_client_spend_report"])["daily_client_spend_report"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, R.daily_client_spend(final).collect()))
    assert summarize_reports(final.select("client_id")) is None
    no_ads = final.where("platform = 'web_traffic'")
    assert report_frames(summarize_reports(no_ads), ["ctr_trends_report"])["ctr_trends_report"].count() == 0
