"""Registered queries over export files that Spark writes from the driver tables.

The exports are text on purpose and partly faulty: two column orders, quoted
commas, missing-value tokens, files without a required column, cut JSON files.
Each query writes them under the shared checkpoint root, reads them back
with the library's readers or streams, and its SQL states what must survive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtrail import schemas as S
from adtrail.session import scratch_folder
from adtrail.sources import bindings as B
from adtrail.sources.files import essential_sources_present, ingest_all, read_source
from adtrail.sources.scan import scan_source
from adtrail.streaming.incremental import read_periods, refresh_changed
from adtrail.streaming.refresh import land_new_files, read_landed, read_quarantine

# fixed values of the exports: which rows go to which kind of file
BUCKETS = 8  # JSON files; the one that is cut, and the one without a required column
CUT_BUCKET, SHORT_BUCKET = 3, 5
SPREAD = 61  # tasks over which the files to write are dealt, so that hardly two meet in one
NO_CHANNEL = 3  # orders with this last digit are in CSV files without a channel column
LATE_DATE, LATE_CLIENT = "1998-06-01", "07"  # rows from this date on, and clients with such ids, arrive in a second landing


def _write_csv(df: DataFrame, folder: str, compression: str = "none") -> None:
    df.write.mode("append").option("header", True).option("escape", '"').option("compression", compression).csv(folder)


def write_revenue_exports(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Orders as revenue CSV files: even keys in the usual column order, odd
    keys in another with one more column, and some files without a channel."""
    orders = B.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    raw = orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("client_id"),
        F.when(key % 17 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        B.revenue_channel().alias("channel"),
        F.when(key % 13 == 0, "N/A").otherwise(F.col("o_totalprice").cast("string")).alias("attributed_revenue"),
        F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('", then left')).alias("note"))
    short = key % 10 == NO_CHANNEL
    _write_csv(raw.where(~short & (key % 2 == 0)).select(*S.REQUIRED_COLUMNS[S.REVENUE]), folder)
    _write_csv(raw.where(~short & (key % 2 == 1)).select("note", "attributed_revenue", "channel", "date", "client_id"), folder)
    _write_csv(raw.where(short).drop("channel", "o_orderkey", "note"), folder)


def _bucket() -> Column:
    return F.pmod("l_orderkey", F.lit(BUCKETS)).cast("int")


def write_facebook_exports(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Lines as facebook JSON files, an array each: one file lacks its last
    bracket, one has no ``reach``. The lines of a file are numbered, not gathered."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = B.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        _bucket().alias("bucket"), "l_orderkey", "l_linenumber",
        F.to_json(F.struct(
            F.when(F.col("l_discount") > 0, F.col("l_partkey").cast("string")).alias("fb_campaign_id"),
            F.col("o_custkey").alias("client"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("date"),
            F.col("l_quantity").cast("long").alias("clicks"),
            F.when(_bucket() != SHORT_BUCKET, (F.col("l_quantity") * (F.col("l_linenumber") - 1) * 20).cast("string")).alias("reach"),
            F.col("l_extendedprice").alias("spend"), F.col("l_linestatus").alias("platform"),
            F.substring("l_returnflag", 1, 1).alias("geo"),
            F.array(F.lit("not"), F.lit("used")).alias("tags"))).alias("json"))
    by_file = Window.partitionBy("bucket").orderBy("l_orderkey", "l_linenumber", "json")
    last = F.lead("json").over(by_file).isNull()
    line = F.concat(F.when(F.row_number().over(by_file) == 1, "[").otherwise(","), F.col("json"),
                    F.when(last & (F.col("bucket") != CUT_BUCKET), "]").otherwise(""))
    # the window's one shuffle and order serve the writer, too
    (rows.repartition(SPREAD, "bucket").select("bucket", line.alias("value"))
     .write.partitionBy("bucket").option("compression", "none").text(folder))


def _exports(spark: SparkSession, sf_dir: str, source: str) -> str:
    folder = scratch_folder(spark, source)
    (write_facebook_exports if source == S.FACEBOOK_ADS else write_revenue_exports)(spark, sf_dir, folder)
    return folder


def q_csv_exports(spark, sf_dir):
    """SRC1-SRC7 by header: revenue rows of both column orders."""
    return read_source(spark, S.REVENUE, _exports(spark, sf_dir, S.REVENUE)).drop("note")


def q_json_exports(spark, sf_dir):
    """SRC3, SRC8: rows of the facebook files that parse and have every required column."""
    return read_source(spark, S.FACEBOOK_ADS, _exports(spark, sf_dir, S.FACEBOOK_ADS))


def q_file_status(spark, sf_dir):
    """SRC7, SRC8: JSON files by status with their records."""
    scan = scan_source(spark, S.FACEBOOK_ADS, _exports(spark, sf_dir, S.FACEBOOK_ADS))
    return (scan.report(spark).groupBy("status", "missing")
            .agg(F.count(F.lit(1)).alias("files"), F.sum(F.when(F.col("status") != "malformed", F.col("records"))).alias("records")))


def _landed(spark, sf_dir, source):
    folder, work = _exports(spark, sf_dir, source), scratch_folder(spark, "landing")
    if source == S.FACEBOOK_ADS:  # Spark names text files .txt; the stream takes *.json
        folder = renamed_copy(spark, folder)
    land_new_files(spark, {source: folder}, work)
    return work


def renamed_copy(spark: SparkSession, folder: str) -> str:
    """The folder's ``.txt`` files under ``.json`` names (a rename each, no data is read)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    root = fs_path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for bucket in fs.listStatus(root):
        if bucket.isDirectory():
            for f in fs.listStatus(bucket.getPath()):
                name = f.getPath().toString()
                if name.endswith(".txt"):
                    fs.rename(f.getPath(), fs_path(name[:-4] + ".json"))
    return folder


def q_stream_csv_landing(spark, sf_dir):
    """STM1, STM2, SRC7 on CSV: landed revenue rows."""
    return read_landed(spark, _landed(spark, sf_dir, S.REVENUE), [S.REVENUE])[S.REVENUE].drop("note")


def q_stream_json_landing(spark, sf_dir):
    """STM1, STM2, SRC3, SRC7 on JSON: landed facebook rows."""
    return read_landed(spark, _landed(spark, sf_dir, S.FACEBOOK_ADS), [S.FACEBOOK_ADS])[S.FACEBOOK_ADS]


def q_stream_quarantine(spark, sf_dir):
    """SRC7, SRC8 on streams: the rejected JSON files."""
    bad = read_quarantine(spark, _landed(spark, sf_dir, S.FACEBOOK_ADS), [S.FACEBOOK_ADS])
    return bad.groupBy("source", "status", "missing").agg(F.count(F.lit(1)).alias("files"))


def q_source_gate(spark, sf_dir):
    """SRC10, SRC11, FLT9: every source of a folder read at once (two have files,
    the others none), its rows, and whether the essential sources are there."""
    paths = {S.REVENUE: _exports(spark, sf_dir, S.REVENUE), S.FACEBOOK_ADS: _exports(spark, sf_dir, S.FACEBOOK_ADS)}
    missing = scratch_folder(spark, "missing")
    data = ingest_all(spark, {s: paths.get(s, f"{missing}/{s}.csv") for s in S.ALL_SOURCES})
    gate = essential_sources_present(data)
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("source"), "rows", F.lit(gate).alias("complete"))
             for s, df in sorted(data.items())]
    return reduce(DataFrame.unionAll, parts)


def land_exports(spark: SparkSession, sf_dir: str, landing: dict[str, str], late: bool) -> None:
    """All six sources as export files, the early or the late rows; the text of all rows is
    large, so it is compressed."""
    for source, raw in B.raw_sources(spark, sf_dir).items():
        if source == S.CLIENTS:
            is_late = F.col("client_id").cast("string").endswith(LATE_CLIENT)
        else:
            is_late = F.expr(f"try_cast(`date` AS date) >= DATE '{LATE_DATE}'")
        rows = raw.where(F.coalesce(is_late, F.lit(False)) == late)
        if source == S.FACEBOOK_ADS:
            # a JSON column without any value in a file would count as absent
            rows.na.fill("", ["geo"]).write.mode("append").option("compression", "gzip").json(landing[source])
        else:
            _write_csv(rows, landing[source], "gzip")


def q_refreshed_months(spark, sf_dir):
    """STM1 without a full rebuild: the final table kept by month; the second landing
    rebuilds the months of its facts, its revenue and its clients' older facts."""
    root = scratch_folder(spark, "refreshed")
    landing = {s: f"{root}/landing/{s}" for s in S.ALL_SOURCES}
    for late in (False, True):
        land_exports(spark, sf_dir, landing, late)
        refresh_changed(spark, landing, f"{root}/work", f"{root}/final", "month", json_lines=True)
    return read_periods(spark, f"{root}/final", "month")


QUERIES = {
    "csv_exports": q_csv_exports,
    "json_exports": q_json_exports,
    "file_status": q_file_status,
    "stream_csv_landing": q_stream_csv_landing,
    "stream_json_landing": q_stream_json_landing,
    "stream_quarantine": q_stream_quarantine,
    "source_gate": q_source_gate,
    "refreshed_months": q_refreshed_months,
}

_REVENUE_SQL = f"""
SELECT CAST(o_custkey AS VARCHAR) AS client_id, CASE WHEN o_orderkey % 17 <> 0 THEN date_trunc('day', o_orderdate)::TIMESTAMP END AS date,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'google_ads' WHEN '2' THEN 'facebook' WHEN '3' THEN 'email'
            WHEN '4' THEN 'organic' ELSE 'other' END AS channel,
       CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS attributed_revenue
FROM orders WHERE o_orderkey % 10 <> {NO_CHANNEL}
"""
_FACEBOOK_SQL = f"""
SELECT CASE WHEN l_discount > 0 THEN CAST(l_partkey AS VARCHAR) END AS fb_campaign_id, CAST(o_custkey AS VARCHAR) AS client,
       date_trunc('day', o_orderdate)::TIMESTAMP AS date, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS clicks,
       l_quantity * (l_linenumber - 1) * 20 AS reach, l_extendedprice AS spend, l_linestatus AS platform, l_returnflag AS geo
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND l_orderkey % {BUCKETS} NOT IN ({CUT_BUCKET}, {SHORT_BUCKET})
"""
_BUCKETS_SQL = f"""
SELECT CASE l_orderkey % {BUCKETS} WHEN {CUT_BUCKET} THEN 'malformed' WHEN {SHORT_BUCKET} THEN 'missing_columns' ELSE 'ok' END AS status,
       CASE l_orderkey % {BUCKETS} WHEN {SHORT_BUCKET} THEN 'reach' END AS missing,
       count(DISTINCT l_orderkey % {BUCKETS}) AS files,
       CASE WHEN status <> 'malformed' THEN count(*) END AS records
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2
"""
ORACLE_SQL = {
    "csv_exports": _REVENUE_SQL,
    "json_exports": _FACEBOOK_SQL,
    "file_status": _BUCKETS_SQL,
    "stream_csv_landing": _REVENUE_SQL,
    "stream_json_landing": _FACEBOOK_SQL,
    "source_gate": f"""
        SELECT 'revenue' AS source, count(*) AS rows, false AS complete FROM ({_REVENUE_SQL})
        UNION ALL SELECT 'facebook_ads', count(*), false FROM ({_FACEBOOK_SQL})
        UNION ALL SELECT s, 0, false FROM (VALUES ('clients'), ('google_ads'), ('email_campaigns'), ('web_traffic')) AS v(s)""",
    "stream_quarantine": f"""SELECT 'facebook_ads' AS source, status, missing, files
                             FROM ({_BUCKETS_SQL}) WHERE status <> 'ok'""",
}
