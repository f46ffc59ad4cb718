import json
import os

import pytest

from adtrail.sources.files import (essential_sources_present, ingest_all, read_csv_source,
                                   read_json_source)
from adtrail.sources.scan import scan_source
from tests.conftest import ts


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_clients_csv_quoted_commas_and_bad_dates(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "clients.csv"),
              'client_id,name,industry,account_manager,signup_date\n'
              'C101,"Acme, Inc.",Retail,Ann,2023-01-05\n'
              'C102,"Say ""Hi"" Co",SaaS,Bob,not-a-date\n'
              'C103,Green,NA,Cy,2022-02-30\n')
    df = read_csv_source(spark, p, "clients")
    rows = {r.client_id: r for r in df.collect()}
    assert rows["C101"].name == "Acme, Inc." and rows["C101"].signup_date == ts("2023-01-05")
    assert rows["C102"].name == 'Say "Hi" Co' and rows["C102"].signup_date is None
    assert rows["C103"].industry is None and rows["C103"].signup_date is None


def test_google_csv_numeric_coercion(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "g.csv"),
              "campaign_id,client_id,date,clicks,impressions,cost_usd,device_type,geo,extra\n"
              "G1,C101,2024-12-01,10,100,5.5,mobile,US,x\n"
              "G2,C101,2024-12-02,ten,N/A,1e2,desktop,,y\n")
    rows = read_csv_source(spark, p, "google_ads").orderBy("campaign_id").collect()
    assert rows[0].clicks == 10.0 and rows[0].cost_usd == 5.5 and rows[0].date == ts("2024-12-01")
    assert rows[1].clicks is None and rows[1].impressions is None and rows[1].cost_usd == 100.0
    assert rows[1].geo is None


def test_missing_required_columns_is_none(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "r.csv"), "client_id,date,channel\nC1,2024-01-01,email\n")
    assert read_csv_source(spark, p, "revenue") is None


def test_empty_and_missing_csv(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "e.csv"), "")
    assert read_csv_source(spark, p, "web_traffic").columns == []
    assert read_csv_source(spark, os.path.join(tmp_dir, "nope.csv"), "web_traffic") is None


def test_header_only_csv_has_columns_no_rows(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "h.csv"), "client_id,date,channel,attributed_revenue\n")
    df = read_csv_source(spark, p, "revenue")
    assert df.columns == ["client_id", "date", "channel", "attributed_revenue"] and df.count() == 0


FB = [{"fb_campaign_id": "F1", "client": "C101", "date": "2024-12-01", "clicks": 5, "reach": 50,
       "spend": 2.5, "platform": "instagram", "geo": "US"},
      {"fb_campaign_id": "F2", "client": "C102", "date": "bad", "clicks": "x", "reach": 10,
       "spend": 1, "platform": "facebook", "geo": "DE"}]


def test_facebook_json_array(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "fb.json"), json.dumps(FB, indent=2))
    rows = {r.fb_campaign_id: r for r in read_json_source(spark, p).collect()}
    assert rows["F1"].clicks == 5.0 and rows["F1"].spend == 2.5 and rows["F1"].date == ts("2024-12-01")
    assert rows["F2"].clicks is None and rows["F2"].date is None and rows["F2"].spend == 1.0


def test_facebook_json_lines(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "fb.jsonl"), "\n".join(json.dumps(r) for r in FB))
    assert read_json_source(spark, p, json_lines=True).count() == 2


def test_bad_json_is_none(spark, tmp_dir):
    assert read_json_source(spark, write(os.path.join(tmp_dir, "m.json"), "[{\"a\": 1,,]")) is None
    assert read_json_source(spark, write(os.path.join(tmp_dir, "z.json"), "")) is None
    assert read_json_source(spark, write(os.path.join(tmp_dir, "l.json"), "[]")) is None
    assert read_json_source(spark, os.path.join(tmp_dir, "none.json")) is None


def test_ingest_all_and_gate(spark, tmp_dir):
    paths = {
        "clients": write(os.path.join(tmp_dir, "clients.csv"),
                         "client_id,name,industry,account_manager,signup_date\nC1,A,B,C,2020-01-01\n"),
        "revenue": write(os.path.join(tmp_dir, "revenue.csv"), "client_id,date\nC1,2024-01-01\n"),
        "web_traffic": os.path.join(tmp_dir, "missing.csv"),
    }
    data = ingest_all(spark, paths)
    assert set(data) == {"clients", "web_traffic"}  # invalid revenue dropped
    assert data["web_traffic"].columns == []  # missing file -> empty marker
    assert not essential_sources_present(data)
    assert essential_sources_present(data, essential=["clients"])


def test_explicit_date_format_per_source(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "rev.csv"),
              "client_id,date,channel,attributed_revenue\nC1,05.12.2024,email,10\nC2,2024-12-05,email,5\n")
    fixed = {r.client_id: r.date for r in read_csv_source(spark, p, "revenue", date_format="dd.MM.yyyy").collect()}
    assert fixed == {"C1": ts("2024-12-05"), "C2": None}  # only the declared layout is accepted
    guessed = {r.client_id: r.date for r in read_csv_source(spark, p, "revenue").collect()}
    assert guessed == {"C1": None, "C2": ts("2024-12-05")}  # without it: ISO and the common layouts


def test_csv_files_of_two_column_orders_go_by_name(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.csv"), "client_id,date,channel,attributed_revenue\nC1,2024-01-01,email,10\n")
    write(os.path.join(tmp_dir, "b.csv"), 'note,attributed_revenue,channel,client_id,date\n"x, ""y""",7.5,organic,C2,2024-01-02\n')
    write(os.path.join(tmp_dir, "c.csv"), "﻿client_id,date,channel,attributed_revenue,Channel\nC3,2024-01-03,email,1,z\n")
    rows = {r.client_id: (r.date, r.channel, r.attributed_revenue, r.note) for r in read_csv_source(spark, tmp_dir, "revenue").collect()}
    assert rows == {"C1": (ts("2024-01-01"), "email", 10.0, None), "C2": (ts("2024-01-02"), "organic", 7.5, 'x, "y"'),
                    "C3": (ts("2024-01-03"), "email", 1.0, None)}


def test_bad_files_are_rejected_one_by_one(spark, tmp_dir):
    write(os.path.join(tmp_dir, "ok.csv"), "client_id,date,channel,attributed_revenue\nC1,2024-01-01,email,10\n")
    write(os.path.join(tmp_dir, "short.csv"), "client_id,date\nC2,2024-01-01\n")
    write(os.path.join(tmp_dir, "blank.csv"), "")
    scan = scan_source(spark, "revenue", tmp_dir)
    assert scan.rows.count() == 1
    got = {r.file.rsplit("/", 1)[1]: (r.status, r.missing) for r in scan.report(spark).collect()}
    assert got == {"ok.csv": ("ok", None), "short.csv": ("missing_columns", "channel,attributed_revenue"), "blank.csv": ("empty", None)}


def test_broken_json_records_never_become_rows(spark, tmp_dir):
    lines = os.path.join(tmp_dir, "lines")
    os.makedirs(lines)
    write(os.path.join(lines, "a.json"), "\n".join([json.dumps(FB[0]), '{"client": "C9", "clicks"', json.dumps(FB[1])]))
    write(os.path.join(lines, "b.json"), json.dumps(FB[1]))
    write(os.path.join(lines, "c.json"), json.dumps({"client": "C1", "clicks": 1}))
    good = read_json_source(spark, lines, json_lines=True).collect()
    assert [r.fb_campaign_id for r in good] == ["F2"]  # a.json is malformed, c.json lacks columns
    loose = read_json_source(spark, lines, json_lines=True, check_files=False).collect()
    assert sorted(str(r.fb_campaign_id) for r in loose) == ["F1", "F2", "F2", "None"] and len(loose) == 4
    status = {s[1].rsplit("/", 1)[1]: s[2:] for s in scan_source(spark, "facebook_ads", lines, json_lines=True).statuses}
    assert status["a.json"] == ("malformed", None, 3, 1) and status["b.json"] == ("ok", None, 1, 0)
    assert status["c.json"][0] == "missing_columns" and "fb_campaign_id" in status["c.json"][1]


def test_json_arrays_with_one_cut_file(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.json"), json.dumps(FB, indent=1))
    write(os.path.join(tmp_dir, "b.json"), json.dumps(FB, indent=1)[:-3])
    write(os.path.join(tmp_dir, "c.json"), "[]")
    assert sorted(r.fb_campaign_id for r in read_json_source(spark, tmp_dir).collect()) == ["F1", "F2"]
    assert [s[2] for s in sorted(scan_source(spark, "facebook_ads", tmp_dir).statuses)] == ["ok", "malformed", "empty"]


LAYOUTS = {
    "lead": lambda rows: "[" + "\n,".join(rows) + "]",
    "trail": lambda rows: "[\n" + ",\n".join(rows) + "\n]\n",
    "windows": lambda rows: "[" + ",\r\n".join(rows) + "]",
}


def raw_row(i: int, **other) -> str:
    row = {**FB[0], "fb_campaign_id": f"F{i}", "geo": 'a "12" \\ é -3 ] [', **other}
    return json.dumps(row, ensure_ascii=False).replace('"spend": 2.5', '"spend": 2.50').replace('"2.5"', "2.50")


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_array_files_with_a_record_a_line_are_split(spark, tmp_dir, layout):
    text = LAYOUTS[layout]([raw_row(i, client=1 if i else "C1", tags=[{"a": -1}], spend=2.5) for i in range(300)])
    p = write(os.path.join(tmp_dir, "a.json"), text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        scan = scan_source(spark, "facebook_ads", p)
        assert scan.rows.rdd.getNumPartitions() > 4  # a multi-line parse has one task a file
        rows = scan.rows.collect()
        by_parse = spark.read.schema(scan.rows.schema).option("multiLine", True).json(p).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert scan.statuses[0][2:] == ("ok", None, 300, 0)
    assert sorted(rows) == sorted(by_parse) and rows[0].spend == "2.50"


@pytest.mark.parametrize("name, text, status", [
    ("cut", "[" + raw_row(1) + "\n," + raw_row(2) + "\n", "malformed"),
    ("cut within a row", "[" + raw_row(1) + ",\n" + raw_row(2) + ",\n" + '{"client": "C', "malformed"),
    ("no comma", "[" + raw_row(1) + "\n" + raw_row(2) + "]", "malformed"),
    ("two commas", "[" + raw_row(1) + ",\n," + raw_row(2) + "]", "malformed"),
    ("comma at the end", "[" + raw_row(1) + ",\n" + raw_row(2) + ",\n]", "malformed"),
    ("not a number", "[" + raw_row(1) + ",\n" + raw_row(2).replace("2.50", "2.5.0") + "]", "malformed"),
    ("two on a line", "[" + raw_row(1) + "," + raw_row(2) + ",\n" + raw_row(3) + "]", "ok"),
    ("single quotes", "[" + raw_row(1) + ",\n" + raw_row(2).replace('"DE"', "'x 1'") + "]", "ok"),
    ("nested text", "[" + raw_row(1) + ",\n" + raw_row(2, platform={"a": [1.50, 2]}) + "]", "ok"),
    ("early end", "[" + raw_row(1) + "]\n[" + raw_row(2) + "]", "ok"),
    ("null record", "[" + raw_row(1) + ",\nnull,\n" + raw_row(2) + "]", None),
    ("one object", raw_row(1), "ok"),
    ("blank", " \n\n", "empty"),
])
def test_array_files_are_judged_as_a_whole_parse_would(spark, tmp_dir, name, text, status):
    p = write(os.path.join(tmp_dir, "a.json"), text)
    scan = scan_source(spark, "facebook_ads", p)
    names = [c for c in scan.rows.columns] if scan.rows is not None else []
    parsed = spark.read.schema("fb_campaign_id string, spend string, platform string, geo string, _bad string")\
        .option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(p).collect()
    if status is None:
        status = "malformed" if any(r._bad is not None for r in parsed) else "ok"
    assert scan.statuses[0][2] == status
    assert (status == "malformed") == any(r._bad is not None for r in parsed)
    if status == "ok":
        assert names and sorted(map(str, scan.rows.select("fb_campaign_id", "spend", "platform", "geo").collect())) == \
            sorted(str(r).replace(", _bad=None", "") for r in parsed)


def test_a_cut_array_is_dropped_without_holding_its_text(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.json"), json.dumps(FB * 3, indent=1)[:-3])
    write(os.path.join(tmp_dir, "b.json"), json.dumps(FB, indent=1))
    loose = read_json_source(spark, tmp_dir, check_files=False)
    assert sorted(r.fb_campaign_id for r in loose.collect()) == ["F1", "F2"]
    assert "_corrupt_record" not in loose._jdf.queryExecution().executedPlan().toString()
