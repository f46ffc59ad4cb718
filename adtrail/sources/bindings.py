"""Raw channel sources derived from the driver's parquet tables.

The driver supplies TPC-H-style tables, not channel exports, so each raw
source is a projection of them under the raw column names its reader
expects. The same projections are written in SQL for the oracle
(``adtrail.plans.oracle``); the two must stay in step.

fixed values (the binding itself):

* google_ads      lineitem x orders, l_returnflag = 'N'
* facebook_ads    lineitem x orders, l_returnflag = 'R'
* email_campaigns lineitem x orders, l_returnflag = 'A', l_linestatus = 'F'
* web_traffic     lineitem x orders, l_returnflag = 'A', l_linestatus = 'O'
* revenue         orders; channel from o_orderpriority
                  1 google_ads, 2 facebook, 3 email, 4 organic, 5 other
* clients         customer x nation, ids with the prefix C; signup_date is
                  text and some values are impossible days (-> NULL)
* faults          facts and revenue of customers ending in 0 carry an id that no
                  client has (C0...), every 37th customer's none; every 29th
                  order has no date, every 19th no revenue

Campaign ids are NULL on lines without discount; impressions are 0 on
line 1; the web duration text has ``H:M:S`` shape on lines 1-4, ``M:S``
on 5-6 and an unparseable shape on line 7.

Scale: the four lineitem sources are disjoint filters of one table; each
is scanned with its own pushed-down filter and only the needed columns,
and joined to the order columns (order key, customer, date). Their union
therefore shuffles each lineitem row once in total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import schemas as S


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the frame is made once per application and path,
    so repeated queries do not re-read parquet footers on the driver."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _line_orders(spark: SparkSession, sf_dir: str, cond: Column) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(cond)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "inner")


def _campaign() -> Column:
    return F.when(F.col("l_discount") > 0, F.col("l_partkey").cast("string"))


def _client() -> Column:
    k, text = F.col("o_custkey"), F.col("o_custkey").cast("string")
    return (F.when(k % 37 == 5, F.lit(None).cast("string")).when(k % 10 == 0, F.concat(F.lit("C0"), text))
            .otherwise(F.concat(F.lit("C"), text)))


def _date() -> Column:
    return F.when(F.col("o_orderkey") % 29 != 3, F.col("o_orderdate"))


def _impressions() -> Column:
    return F.col("l_quantity") * (F.col("l_linenumber") - 1) * 20


def raw_google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir, F.col("l_returnflag") == "N")
    return lo.select(
        _campaign().alias("campaign_id"), _client().alias("client_id"),
        _date().alias("date"), F.col("l_quantity").alias("clicks"),
        _impressions().alias("impressions"), F.col("l_extendedprice").alias("cost_usd"),
        F.col("l_linestatus").alias("device_type"), F.lit(None).cast("string").alias("geo"))


def raw_facebook_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir, F.col("l_returnflag") == "R")
    return lo.select(
        _campaign().alias("fb_campaign_id"), _client().alias("client"),
        _date().alias("date"), F.col("l_quantity").alias("clicks"),
        _impressions().alias("reach"), F.col("l_extendedprice").alias("spend"),
        F.col("l_linestatus").alias("platform"), F.lit(None).cast("string").alias("geo"))


def raw_email_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir, (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"))
    return lo.select(
        _campaign().alias("email_id"), _client().alias("client_id"),
        _date().alias("date"), (F.col("l_quantity") * 1000).alias("emails_sent"),
        F.col("l_discount").alias("open_rate"), F.col("l_tax").alias("click_rate"),
        F.lit(None).cast("string").alias("subject_line"))


def _duration_text() -> Column:
    ln = F.col("l_linenumber")
    q = F.col("l_quantity").cast("bigint")
    s = (F.col("l_suppkey") % 60).cast("string")
    return (F.when(ln <= 4, F.concat_ws(":", (ln - 1).cast("string"), (q % 60).cast("string"), s))
            .when(ln <= 6, F.concat_ws(":", q.cast("string"), s))
            .otherwise(F.concat(q.cast("string"), F.lit("m"), s, F.lit("s"))))


def raw_web_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = _line_orders(spark, sf_dir, (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"))
    return lo.select(
        _client().alias("client_id"), _date().alias("date"),
        (F.col("l_quantity") * 20).alias("pageviews"), (F.col("l_quantity") * 10).alias("sessions"),
        F.col("l_discount").alias("bounce_rate"), _duration_text().alias("avg_session_duration"))


def revenue_channel() -> Column:
    p = F.substring("o_orderpriority", 1, 1)
    return (F.when(p == "1", "google_ads").when(p == "2", "facebook").when(p == "3", "email")
            .when(p == "4", "organic").otherwise("other"))


def revenue_projection(orders: DataFrame) -> DataFrame:
    """Raw revenue rows from order rows; works on a static or a streaming
    frame."""
    return orders.select(_client().alias("client_id"), _date().alias("date"),
                         revenue_channel().alias("channel"), F.when(F.col("o_orderkey") % 19 != 2, F.col("o_totalprice")).alias("attributed_revenue"))


def raw_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_projection(table(spark, sf_dir, "orders"))


def _signup_text() -> Column:
    k = F.col("c_custkey")
    return F.concat_ws("-", (1990 + k % 8).cast("string"),
                       F.lpad((1 + k % 12).cast("string"), 2, "0"),
                       F.lpad((1 + k % 31).cast("string"), 2, "0"))


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the 25 nation names as one looked-up value: a join would hide from the planner how small the clients are
    nations = (table(spark, sf_dir, "nation")
               .agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name")))).scalar())
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("client_id"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("industry"),
        F.try_element_at(nations, F.col("c_nationkey")).alias("account_manager"), _signup_text().alias("signup_date"))


def web_projection_from_events(events: DataFrame) -> DataFrame:
    """Raw web-traffic rows from event rows (static or streaming): one hit
    per event, the day as ``yyyy-MM-dd`` text (day truncation happens here,
    the reader parses the text), views count as page views, views and
    clicks as sessions, errors as bounces, and the event value as an
    ``M:SS`` duration text."""
    kind = F.col("event_type")
    secs = F.floor(F.col("value")).cast("bigint")
    return events.select(
        F.col("user_id").cast("string").alias("client_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(kind == "view", 1).otherwise(0).alias("pageviews"),
        F.when(kind.isin("view", "click"), 1).otherwise(0).alias("sessions"),
        F.when(kind == "error", 1.0).otherwise(0.0).alias("bounce_rate"),
        F.concat_ws(":", (secs / 60).cast("bigint").cast("string"),
                    F.lpad((secs % 60).cast("string"), 2, "0")).alias("avg_session_duration"))


RAW_BINDINGS = {
    S.GOOGLE_ADS: raw_google_ads,
    S.FACEBOOK_ADS: raw_facebook_ads,
    S.EMAIL_CAMPAIGNS: raw_email_campaigns,
    S.WEB_TRAFFIC: raw_web_traffic,
    S.REVENUE: raw_revenue,
    S.CLIENTS: raw_clients,
}


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six raw sources, lazily, keyed by source name."""
    return {name: fn(spark, sf_dir) for name, fn in RAW_BINDINGS.items()}


def ingested_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw sources after the reader-level coercions (dates and numbers
    parsed). They are typed columns, not text exports, so the
    missing-value-token check is skipped."""
    from adtrail.sources.files import coerce_source
    return {name: coerce_source(df, name, text_tokens=False)
            for name, df in raw_sources(spark, sf_dir).items()}
