"""Interactive exploration: filters, headline totals and chart aggregates
(FLT1-FLT7, AG8-AG16, SRT3, LIM1, DT3).

Filters are plain predicates, so Catalyst pushes them into the parquet
scan (row-group pruning on ``date``, folder pruning on ``platform`` when
the table is partitioned by it).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail.functions import metrics as M
from adtrail.operators.reports import ad_platform_rows, has_columns, keys_not_null

ALL = "All"


def _ts(value) -> F.Column:
    if isinstance(value, _dt.datetime):
        # as text: a datetime literal would shift by the process time zone
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    try:  # a filter that cannot be read is an error, not an empty result (DT2)
        return _ts(_dt.datetime.fromisoformat(str(value).strip()))
    except ValueError as err:
        raise ValueError(f"not a date: {value!r}") from err


def apply_filters(df: DataFrame, client: str = ALL, platform: str = ALL,
                  date_range: Sequence = ()) -> DataFrame:
    """Client / platform equality ('All' = no filter); a 2-item range is
    inclusive, a 1-item range means that day, any other length no date
    filter (FLT1-FLT4)."""
    if client != ALL:
        df = df.where(F.col("client_id") == F.lit(client))
    if platform != ALL:
        df = df.where(F.col("platform") == F.lit(platform))
    if len(date_range) == 2:
        df = df.where(F.col("date").between(_ts(date_range[0]), _ts(date_range[1])))
    elif len(date_range) == 1:
        df = df.where(F.col("date") == _ts(date_range[0]))
    return df


def key_totals(df: DataFrame) -> DataFrame:
    """One row of headline totals; 0 for absent columns or no rows (AG8)."""
    def total(col: str, money: bool):
        if col not in df.columns:
            return F.lit(0.0) if money else F.lit(0).cast("bigint")
        agg = M.money_sum(col) if money else M.count_sum(col)
        return F.coalesce(agg, F.lit(0.0) if money else F.lit(0).cast("bigint"))

    return df.agg(
        total("spend_usd", True).alias("total_spend_usd"),
        total("clicks", False).alias("total_clicks"),
        total("impressions", False).alias("total_impressions"),
        total("sessions", False).alias("total_sessions"),
        total("emails_sent", False).alias("total_emails_sent"),
        total(S.ATTRIBUTED_REVENUE_COL, True).alias("total_attributed_revenue_usd"),
    )


def format_key_totals(totals: DataFrame) -> DataFrame:
    """Display strings for the headline totals: money as ``$1,234.56``,
    counts as ``1,234`` (FMT1)."""
    money = ["total_spend_usd", "total_attributed_revenue_usd"]
    return totals.select(*[
        (F.concat(F.lit("$"), F.format_number(c, 2)) if c in money else F.format_number(c, 0)).alias(c)
        for c in totals.columns])


def spend_by_platform(df: DataFrame) -> DataFrame | None:
    """platform -> spend_usd (AG9). None when an input column is missing
    (FLT8), as for every chart below."""
    if not has_columns(df, "platform", "spend_usd"):
        return None
    return (df.where(keys_not_null("platform")).groupBy("platform")
            .agg(M.money_sum("spend_usd").alias("spend_usd")))


def clicks_over_time(df: DataFrame) -> DataFrame | None:
    """date -> clicks (AG10)."""
    if not has_columns(df, "date", "clicks"):
        return None
    return (df.where(keys_not_null("date")).groupBy("date")
            .agg(M.count_sum("clicks").alias("clicks")))


def ctr_by_platform(df: DataFrame) -> DataFrame | None:
    """Ad platform -> total_clicks, total_impressions, aggregate_ctr (AG11)."""
    if not has_columns(df, "platform", "clicks", "impressions"):
        return None
    per = (ad_platform_rows(df).groupBy("platform")
           .agg(M.count_sum("clicks").alias("total_clicks"),
                M.count_sum("impressions").alias("total_impressions")))
    return per.withColumn("aggregate_ctr", M.ctr("total_clicks", "total_impressions"))


def web_daily(df: DataFrame) -> DataFrame | None:
    """date -> total_sessions, total_pageviews for web traffic (AG12)."""
    if not has_columns(df, "date", "sessions", "pageviews", "platform"):
        return None
    web = df.where((F.col("platform") == S.WEB_TRAFFIC) & keys_not_null("date"))
    return web.groupBy("date").agg(M.count_sum("sessions").alias("total_sessions"),
                                   M.count_sum("pageviews").alias("total_pageviews"))


def revenue_over_time(df: DataFrame) -> DataFrame | None:
    """(date, platform) -> attributed revenue, only groups above 0
    (AG13, FLT7)."""
    if not has_columns(df, "date", "platform", S.ATTRIBUTED_REVENUE_COL):
        return None
    keys = ["date", "platform"]
    per = (df.where(keys_not_null(*keys)).groupBy(*keys)
           .agg(M.money_sum(S.ATTRIBUTED_REVENUE_COL).alias(S.ATTRIBUTED_REVENUE_COL)))
    return per.where(F.col(S.ATTRIBUTED_REVENUE_COL) > 0)


def date_bounds(df: DataFrame) -> DataFrame:
    """First and last day, also as ``YYYY-MM-DD`` labels (AG15, DT3)."""
    b = df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    return b.withColumns({"min_label": F.date_format("min_date", "yyyy-MM-dd"),
                          "max_label": F.date_format("max_date", "yyyy-MM-dd")})


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of a column (AG16)."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def selector_options(df: DataFrame, column: str) -> DataFrame:
    """'All' followed by the sorted distinct values (SRT3), as a frame
    (the value list is never gathered on the driver)."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("option")).distinct()
    everything = values.sparkSession.range(1).select(F.lit(ALL).alias("option"))
    ranked = everything.withColumn("_rank", F.lit(0)).unionByName(values.withColumn("_rank", F.lit(1)))
    return ranked.orderBy("_rank", "option").drop("_rank")


# fixed values: the deterministic order used for previews
PREVIEW_ORDER = ["date", "client_id", "platform", "campaign_id"]


def preview(df: DataFrame, n: int = 5, ordered: bool = False) -> DataFrame:
    """First ``n`` rows (LIM1), from as few partitions as hold them. With
    ``ordered`` the first in a fixed order: a top-k over the whole table, in
    which each task keeps its best n rows."""
    if not ordered:
        return df.limit(n)
    lead = [c for c in PREVIEW_ORDER if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in lead + rest]).limit(n)


def dashboard_views(df: DataFrame, client: str = ALL, platform: str = ALL,
                    date_range: Sequence = ()) -> dict[str, DataFrame | None]:
    """Everything the interactive dashboard shows, as lazy frames: selector
    options and date bounds over the whole table, then the filtered
    preview, headline totals, five charts and the two report charts over
    the filtered rows. A chart whose inputs are missing is None. Nothing
    runs until a frame is used; each is its own small job."""
    from adtrail.operators.reports import clicks_by_platform, ctr_trends
    view = apply_filters(df, client, platform, date_range)
    return {
        "client_options": selector_options(df, "client_id"),
        "platform_options": selector_options(df, "platform"),
        "date_bounds": date_bounds(df),
        "preview": preview(view),
        "key_totals": key_totals(view),
        "spend_by_platform": spend_by_platform(view),
        "clicks_over_time": clicks_over_time(view),
        "ctr_by_platform": ctr_by_platform(view),
        "web_daily": web_daily(view),
        "revenue_over_time": revenue_over_time(view),
        "clicks_by_platform": clicks_by_platform(view),
        "ctr_trends": ctr_trends(view),
    }
