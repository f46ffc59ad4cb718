"""Whole runs on raw files written by the test: batch and streaming refresh."""

import json
import os

import pytest

from adtrail import schemas as S
from adtrail.plans.batch import run_batch
from adtrail.sources.analytics import load_analytics
from adtrail.streaming.refresh import read_quarantine, refresh

FILES = {
    "clients.csv": "client_id,name,industry,account_manager,signup_date\n"
                   "C101,\"Acme, Inc.\",Retail,Ann,2023-01-05\nC102,Bright,SaaS,Bob,2022-05-15\n",
    "google_ads.csv": "campaign_id,client_id,date,clicks,impressions,cost_usd,device_type,geo\n"
                      "G1,C101,2024-12-01,10,100,5.0,mobile,US\nG1,C101,2024-12-01,30,900,15.0,desktop,US\n"
                      "G2,C999,2024-12-02,5,0,1.0,mobile,FR\n",
    "email_campaigns.csv": "email_id,client_id,date,emails_sent,open_rate,click_rate,subject_line\n"
                           "E1,C102,2024-12-01,1000,0.2,0.05,Hello\n",
    "web_traffic.csv": "client_id,date,pageviews,sessions,bounce_rate,avg_session_duration\n"
                       "C101,2024-12-01,200,80,0.4,0:02:30\nC102,2024-12-02,50,20,0.5,oops\n",
    "revenue.csv": "client_id,date,channel,attributed_revenue\n"
                   "C101,2024-12-01,google_ads,100.0\nC101,2024-12-01,organic,30.0\nC102,2024-12-01,email,NA\n",
}
FACEBOOK = [{"fb_campaign_id": "F1", "client": "C102", "date": "2024-12-02", "clicks": 7, "reach": 70,
             "spend": 3.5, "platform": "instagram", "geo": "DE"}]


def write_sources(root, layout="flat"):
    paths = {}
    for name, text in FILES.items():
        src = name.rsplit(".", 1)[0]
        folder = root if layout == "flat" else os.path.join(root, src)
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
        paths[src] = os.path.join(folder, name) if layout == "flat" else folder
    folder = root if layout == "flat" else os.path.join(root, "facebook_ads")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "facebook_ads.json"), "w") as f:
        json.dump(FACEBOOK, f)
    paths["facebook_ads"] = os.path.join(folder, "facebook_ads.json") if layout == "flat" else folder
    return paths


def check_final(final):
    rows = final.collect()
    assert len(rows) == 10  # 3 google + 1 fb + 1 email + 2 web + 3 revenue rows
    assert len(final.columns) == len(S.FINAL_COLUMNS)
    by = {(r.platform, r.client_id, r.clicks): r for r in rows}
    g = by[("google_ads", "C101", 10)]
    assert g.name == "Acme, Inc." and g.ctr == 10.0 and g.cpc_usd == 0.5
    assert g.attributed_revenue_from_source_usd == 100.0  # full daily revenue on each touchpoint
    assert by[("google_ads", "C101", 30)].attributed_revenue_from_source_usd == 100.0
    unknown = by[("google_ads", "C999", 5)]
    assert unknown.name == "Unknown" and unknown.ctr == 0.0
    web = [r for r in rows if r.platform == "web_traffic"]
    assert sorted(r.avg_session_duration_seconds for r in web) == [0, 150]
    assert {r.attributed_revenue_from_source_usd for r in web if r.client_id == "C101"} == {30.0}
    assert all(r.attributed_revenue_from_source_usd == 0.0 for r in rows if r.platform == "revenue")


def test_run_batch(spark, tmp_dir):
    paths = write_sources(os.path.join(tmp_dir, "raw"))
    out_path = os.path.join(tmp_dir, "processed", "final")
    reports = os.path.join(tmp_dir, "reports")
    written = run_batch(spark, paths, {"parquet": {"save": True, "path": out_path}}, reports)
    assert written["path"] == out_path
    assert written["quality"] == {"rows": 10, "rows_without_date": 0, "rows_with_unknown_client": 1,
                                  "rows_with_revenue": 3}
    check_final(load_analytics(spark, out_path))
    assert sorted(os.listdir(reports)) == [
        "campaign_summary_report", "cross_channel_lift_report", "ctr_trends_report",
        "daily_client_spend_report", "total_clicks_by_platform_report"]


def test_run_batch_stops_without_essentials(spark, tmp_dir):
    paths = write_sources(os.path.join(tmp_dir, "raw"))
    paths["web_traffic"] = os.path.join(tmp_dir, "raw", "missing.csv")
    assert run_batch(spark, paths, {"parquet": {"save": True, "path": os.path.join(tmp_dir, "f")}},
                     os.path.join(tmp_dir, "r")) is None
    assert not os.path.exists(os.path.join(tmp_dir, "f"))


def test_streaming_refresh_on_arrival(spark, tmp_dir):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout="folders")
    work = os.path.join(tmp_dir, "work")
    ckpt = os.path.join(tmp_dir, "ckpt")
    out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final_v1")}}
    refresh(spark, landing, work, out, checkpoint_root=ckpt)
    check_final(load_analytics(spark, out["parquet"]["path"]))

    # a second revenue file arrives (and a stray non-csv file that must be ignored)
    with open(os.path.join(landing["revenue"], "revenue_2.csv"), "w") as f:
        f.write("client_id,date,channel,attributed_revenue\nC102,2024-12-02,facebook,40.0\n")
    with open(os.path.join(landing["revenue"], "notes.txt"), "w") as f:
        f.write("not data")
    out2 = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final_v2")}}
    refresh(spark, landing, work, out2, checkpoint_root=ckpt)
    final = load_analytics(spark, out2["parquet"]["path"])
    assert final.count() == 11  # one new revenue fact row
    fb = final.where("platform = 'facebook_ads'").first()
    assert fb.attributed_revenue_from_source_usd == 40.0  # old touchpoint re-attributed


def test_streaming_replay_is_idempotent(spark, tmp_dir):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout="folders")
    work, ckpt = os.path.join(tmp_dir, "work"), os.path.join(tmp_dir, "ckpt")
    for i in range(2):  # second run finds no new files and lands nothing twice
        out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, f"final_{i}")}}
        refresh(spark, landing, work, out, checkpoint_root=ckpt)
        assert load_analytics(spark, out["parquet"]["path"]).count() == 10


@pytest.mark.parametrize("layout", ["folders"])
def test_streaming_without_revenue(spark, tmp_dir, layout):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout=layout)
    landing.pop("revenue")
    out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final")}}
    refresh(spark, landing, os.path.join(tmp_dir, "work"), out, checkpoint_root=os.path.join(tmp_dir, "ck"))
    final = load_analytics(spark, out["parquet"]["path"])
    assert final.count() == 7
    assert {r[0] for r in final.select(S.ATTRIBUTED_REVENUE_COL).collect()} == {0.0}


def test_command_line_batch_and_refresh(spark, tmp_dir):
    from adtrail.__main__ import main
    raw = os.path.join(tmp_dir, "raw")
    write_sources(raw)
    out = os.path.join(tmp_dir, "final")
    written = main(["batch", "--raw-dir", raw, "--out", out, "--reports", os.path.join(tmp_dir, "rep")], spark)
    assert written["path"] == out
    check_final(load_analytics(spark, out))
    landing = os.path.join(tmp_dir, "landing")
    write_sources(landing, layout="folders")
    written = main(["refresh", "--landing-dir", landing, "--work-dir", os.path.join(tmp_dir, "work"),
                    "--checkpoint-dir", os.path.join(tmp_dir, "ck"), "--format", "table",
                    "--table", "cli_final"], spark)
    assert written["table"] == "cli_final"
    check_final(load_analytics(spark, fmt="table", table="cli_final"))


def test_streaming_backlog_in_bounded_batches(spark, tmp_dir):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout="folders")
    for i in range(3):  # a backlog of extra revenue files
        with open(os.path.join(landing["revenue"], f"more_{i}.csv"), "w") as f:
            f.write(f"client_id,date,channel,attributed_revenue\nC102,2024-12-0{i + 3},email,1.0\n")
    work = os.path.join(tmp_dir, "work")
    out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final")}}
    refresh(spark, landing, work, out, checkpoint_root=os.path.join(tmp_dir, "ck"), max_files_per_trigger=1)
    assert len([d for d in os.listdir(os.path.join(work, "bronze", "revenue")) if d.startswith("batch=")]) == 4
    assert load_analytics(spark, out["parquet"]["path"]).count() == 13


def test_streaming_csv_with_reordered_and_extra_columns(spark, tmp_dir):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout="folders")
    g = os.path.join(landing["google_ads"], "google_ads.csv")
    with open(g, "w") as f:  # same rows, columns shuffled, one extra column
        f.write("geo,cost_usd,note,client_id,clicks,date,impressions,device_type,campaign_id\n"
                "US,5.0,x,C101,10,2024-12-01,100,mobile,G1\nUS,15.0,y,C101,30,2024-12-01,900,desktop,G1\n"
                "FR,1.0,z,C999,5,2024-12-02,0,mobile,G2\n")
    out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final")}}
    refresh(spark, landing, os.path.join(tmp_dir, "work"), out, checkpoint_root=os.path.join(tmp_dir, "ck"))
    check_final(load_analytics(spark, out["parquet"]["path"]))


def test_streaming_files_of_other_layouts_and_bad_files(spark, tmp_dir):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout="folders")
    work, ck = os.path.join(tmp_dir, "work"), os.path.join(tmp_dir, "ck")
    refresh(spark, landing, work, {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final")}}, checkpoint_root=ck)
    assert read_quarantine(spark, work).count() == 0
    files = {("revenue", "swapped.csv"): "date,client_id,attributed_revenue,channel\n2024-12-02,C102,40.0,facebook\n",
             ("revenue", "short.csv"): "date,client_id,channel\n2024-12-02,C102,facebook\n", ("revenue", "none.csv"): "",
             ("facebook_ads", "cut.json"): json.dumps(FACEBOOK)[:-9],
             ("facebook_ads", "few.json"): json.dumps([{"client": "C101", "date": "2024-12-01"}])}
    for (source, name), text in files.items():
        with open(os.path.join(landing[source], name), "w") as f:
            f.write(text)
    out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "f2")}}
    refresh(spark, landing, work, out, checkpoint_root=ck)
    final = load_analytics(spark, out["parquet"]["path"])
    assert final.count() == 11  # the swapped file's row only
    assert final.where("platform = 'facebook_ads'").first().attributed_revenue_from_source_usd == 40.0
    bad = {(r.source, r.file.rsplit("/", 1)[1]): r.status for r in read_quarantine(spark, work).collect()}
    assert bad == {("revenue", "short.csv"): "missing_columns", ("facebook_ads", "cut.json"): "malformed",
                   ("facebook_ads", "few.json"): "missing_columns"}


def test_streaming_json_lines_and_quality(spark, tmp_dir):
    landing = write_sources(os.path.join(tmp_dir, "landing"), layout="folders")
    fb = os.path.join(landing["facebook_ads"], "facebook_ads.json")
    with open(fb, "w") as f:  # the same export as JSON Lines
        f.write("\n".join(json.dumps(r) for r in FACEBOOK) + "\n")
    out = {"parquet": {"save": True, "path": os.path.join(tmp_dir, "final")}}
    written = refresh(spark, landing, os.path.join(tmp_dir, "work"), out,
                      checkpoint_root=os.path.join(tmp_dir, "ck"), json_lines=True)
    check_final(load_analytics(spark, out["parquet"]["path"]))
    assert written["quality"]["rows"] == 10 and written["quality"]["rows_with_unknown_client"] == 1


def test_command_line_reader_options(spark, tmp_dir):
    from adtrail.__main__ import main
    raw = os.path.join(tmp_dir, "raw")
    write_sources(raw)
    os.remove(os.path.join(raw, "facebook_ads.json"))
    with open(os.path.join(raw, "facebook_ads.jsonl"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in FACEBOOK) + "\n")
    out = os.path.join(tmp_dir, "final")
    main(["batch", "--raw-dir", raw, "--out", out, "--json-lines", "--csv-multiline",
          "--date-format", "yyyy-MM-dd"], spark)
    check_final(load_analytics(spark, out))
