"""Refreshes that rebuild the changed periods only, against full rebuilds."""

import glob
import gzip
import os
from collections import Counter
from datetime import date

import pytest

from adtrail import schemas as S
from adtrail import versions as V
from adtrail.plans.exports import land_exports
from adtrail.session import SHUFFLE_CLEANUP
from adtrail.streaming import incremental as I
from adtrail.streaming.refresh import read_landed
from adtrail.plans.batch import transform_sources
from tests.test_sinks import gone, shuffle_files

HEADERS = {s: ",".join(S.REQUIRED_COLUMNS[s]) for s in S.ALL_SOURCES}


class Landing:
    """Landing folders of a test with its refreshes."""

    def __init__(self, spark, root):
        self.spark, self.work, self.path = spark, os.path.join(root, "work"), os.path.join(root, "final")
        self.folders = {s: os.path.join(root, "landing", s) for s in S.ALL_SOURCES}
        self.n = 0

    def put(self, source, *lines):
        os.makedirs(self.folders[source], exist_ok=True)
        self.n += 1
        if source == S.FACEBOOK_ADS:
            text = "[" + ",".join(lines) + "]"
        else:
            text = "\n".join([HEADERS[source], *lines, ""])
        with open(os.path.join(self.folders[source], f"f{self.n}.{'json' if source == S.FACEBOOK_ADS else 'csv'}"), "w") as f:
            f.write(text)

    def first(self):
        self.put(S.CLIENTS, "K1,One,Retail,Ann,2020-01-01", "K2,Two,Media,Bo,2021-01-01")
        self.put(S.GOOGLE_ADS, "g1,K1,2031-05-01,4,40,2.5,mobile,US", "g2,K9,2031-05-02,1,9,1.5,tv,FR", "g3,K1,someday,2,2,2,tv,FR")
        self.put(S.FACEBOOK_ADS, '{"fb_campaign_id":"f1","client":"K2","date":"2031-05-03","clicks":3,"reach":30,"spend":1.0,"platform":"p","geo":"DE"}')
        self.put(S.EMAIL_CAMPAIGNS, "e1,K2,2031-05-04,100,0.5,0.1,Hi")
        self.put(S.WEB_TRAFFIC, "K1,2031-05-01,10,5,0.5,1:30")

    def refresh(self, kind="day"):
        return I.refresh_changed(self.spark, self.folders, self.work, self.path, kind)

    def check(self, kind="day"):
        """The kept table holds the rows of a full rebuild."""
        got = I.read_periods(self.spark, self.path, kind)
        want = transform_sources(read_landed(self.spark, self.work))
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))

    def files(self):
        return {d: sorted(f for f in os.listdir(os.path.join(self.path, d)) if f.endswith(".parquet"))
                for d in os.listdir(self.path) if "=" in d}


@pytest.fixture
def landing(spark, tmp_dir):
    out = Landing(spark, tmp_dir)
    for folder in out.folders.values():
        os.makedirs(folder)
    return out


def test_only_changed_days_are_rebuilt(landing):
    landing.first()
    assert landing.refresh() == ["2031-05-01", "2031-05-02", "2031-05-03", "2031-05-04", None]
    landing.check()
    before = landing.files()
    landing.put(S.REVENUE, "K1,2031-05-01,google_ads,70.0", "K1,2031-05-09,organic,5.0")
    assert landing.refresh() == ["2031-05-01", "2031-05-09"]
    landing.check()
    after = landing.files()
    same = {d for d in before if before[d] == after[d]}
    assert same == {"day=2031-05-02", "day=2031-05-03", "day=2031-05-04", "day=__HIVE_DEFAULT_PARTITION__"}
    row = I.read_periods(landing.spark, landing.path, first=date(2031, 5, 1), last="2031-05-01").where("platform = 'google_ads'").first()
    assert row.attributed_revenue_from_source_usd == 70.0
    assert landing.refresh() == [] and landing.files() == after


def test_new_client_rebuilds_the_days_of_its_facts(landing):
    landing.first()
    landing.refresh()
    landing.put(S.CLIENTS, "K9,Nine,Toys,Di,2022-02-02", "K1,One again,Retail,Ann,2020-01-01")
    assert landing.refresh() == ["2031-05-01", "2031-05-02", None]
    landing.check()  # the repeated client's facts stand twice, as in a full rebuild
    names = {r.name for r in I.read_periods(landing.spark, landing.path).where("client_id = 'K9'").collect()}
    assert names == {"Nine"}


def test_missing_essential_source_waits(landing):
    landing.put(S.CLIENTS, "K1,One,Retail,Ann,2020-01-01")
    assert landing.refresh() is None and not os.path.exists(landing.path)
    landing.first()
    assert landing.refresh()[0] == "2031-05-01"
    landing.check()


def test_death_before_the_note_repeats_the_refresh(landing, monkeypatch):
    landing.first()
    landing.refresh()
    landing.put(S.WEB_TRAFFIC, "K2,2031-05-04,7,7,0.1,0:10")

    def dies(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(V, "set_current", dies)
        with pytest.raises(RuntimeError):
            landing.refresh()
    landing.put(S.WEB_TRAFFIC, "K2,2031-05-06,7,7,0.1,0:10")
    assert landing.refresh() == ["2031-05-04", "2031-05-06"]
    landing.check()


def test_death_in_the_write_leaves_the_table(landing, monkeypatch):
    landing.first()
    landing.refresh()
    before = landing.files()
    landing.put(S.GOOGLE_ADS, "g9,K2,2031-05-02,7,7,1.0,tv,FR")
    whole = I._spread_write

    def dies(df, path, *rest):
        if path == landing.path:
            raise RuntimeError("driver lost")
        whole(df, path, *rest)
    with monkeypatch.context() as m:
        m.setattr(I, "_spread_write", dies)
        with pytest.raises(RuntimeError):
            landing.refresh()
    assert landing.files() == before
    assert landing.refresh() == ["2031-05-02"]
    landing.check()


def test_months_and_files_without_rows(landing):
    landing.first()
    landing.put(S.REVENUE)
    assert landing.refresh("month") == ["2031-05-01", None]
    landing.check("month")
    landing.put(S.REVENUE, "K2,2031-06-30,facebook,1.0")
    assert landing.refresh("month") == ["2031-06-01"]
    landing.check("month")
    june = I.read_periods(landing.spark, landing.path, "month", first="2031-06-15")
    assert june.count() == 1 and "month=2031-06-01" in "".join(june.inputFiles())


def test_unknown_period(landing):
    with pytest.raises(ValueError):
        landing.refresh("hour")


def test_periods_are_written_without_a_second_run_of_the_plan(spark, tmp_path):
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 > 0 THEN add_months(DATE '2024-01-01', int(id % 3)) END AS month")
    path = str(tmp_path / "periods")
    I._spread_write(df.mapInArrow(counted, df.schema), path, ["month"], "static")
    assert passed.value == 1000
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.where("month IS NULL").count() == 100 and back.select("month").distinct().count() == 4


def test_compressed_files_land_and_shuffle_files_go(landing, monkeypatch):
    landing.first()
    landing.refresh("month")
    setting, whole, seen = landing.spark.conf.get(SHUFFLE_CLEANUP, None), I._spread_write, []

    def noted(*args):
        before = shuffle_files(landing.spark)
        whole(*args)
        if args[1] == landing.path:  # the only job at that time
            seen.append(gone(landing.spark, before))
    monkeypatch.setattr(I, "_spread_write", noted)
    landing.put(S.REVENUE, "K2,2031-07-30,facebook,1.0")
    [new] = [f for f in glob.glob(f"{landing.folders[S.REVENUE]}/*.csv") if "2031-07-30" in open(f).read()]
    with open(new, "rb") as plain, gzip.open(f"{landing.folders[S.REVENUE]}/late.csv.gz", "wb") as packed:
        packed.write(plain.read().replace(b"2031-07-30", b"2031-08-30"))
    assert landing.refresh("month") == ["2031-07-01", "2031-08-01"]
    assert seen == [True] and landing.spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_exports_are_compressed(spark, tmp_path):
    day = "TIMESTAMP_NTZ '1997-05-06 00:00:00'"
    rows = {"nation": ["0 AS n_nationkey", "'N' AS n_name"],
            "customer": ["id AS c_custkey", "'c' AS c_name", "0 AS c_nationkey", "'m' AS c_mktsegment"],
            "orders": ["id AS o_orderkey", "id AS o_custkey", "2.5D AS o_totalprice", f"{day} AS o_orderdate", "'1-URGENT' AS o_orderpriority"],
            "lineitem": ["id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "2 AS l_linenumber", "3D AS l_quantity",
                         "4D AS l_extendedprice", "0.1D AS l_discount", "0.2D AS l_tax", "substr('NRAA', int(id % 4) + 1, 1) AS l_returnflag",
                         "substr('OFFO', int(id % 4) + 1, 1) AS l_linestatus"]}
    for name, cols in rows.items():
        spark.range(1 if name == "nation" else 40).selectExpr(*cols).write.parquet(str(tmp_path / f"{name}.parquet"))
    folders = {s: str(tmp_path / "landing" / s) for s in S.ALL_SOURCES}
    land_exports(spark, str(tmp_path), folders, False)
    for source, folder in folders.items():
        files = glob.glob(f"{folder}/part-*")
        assert files and all(f.endswith(".gz") for f in files), source
