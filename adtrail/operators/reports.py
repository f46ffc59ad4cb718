"""The four summary reports (AG2-AG5).

Each report is a grouped aggregate over the final table. NULL group keys
are dropped first, matching the reference's group-by. A report whose input
columns are missing returns None (FLT8). Money is summed exactly
(decimal), counts as bigint; the CTR is a ratio of sums, never a mean of
row CTRs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail.functions import metrics as M


def has_columns(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def keys_not_null(*keys: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def daily_client_spend(df: DataFrame) -> DataFrame | None:
    """(date, client_id) -> spend_usd (AG2)."""
    if not has_columns(df, "spend_usd", "client_id", "date"):
        return None
    keys = ["date", "client_id"]
    return (df.where(keys_not_null(*keys)).groupBy(*keys)
            .agg(M.money_sum("spend_usd").alias("spend_usd")))


def clicks_by_platform(df: DataFrame) -> DataFrame | None:
    """platform -> clicks (AG3)."""
    if not has_columns(df, "clicks", "platform"):
        return None
    return (df.where(keys_not_null("platform")).groupBy("platform")
            .agg(M.count_sum("clicks").alias("clicks")))


def ad_platform_rows(df: DataFrame) -> DataFrame:
    """Rows of the two ad platforms (FLT5). On a table partitioned by
    platform this prunes to two partition folders."""
    return df.where(F.col("platform").isin(S.AD_PLATFORMS))


def ctr_trends(df: DataFrame) -> DataFrame | None:
    """date -> total_clicks, total_impressions, daily_ctr over ad platforms
    (AG4)."""
    if not has_columns(df, "clicks", "impressions", "date", "platform"):
        return None
    daily = (ad_platform_rows(df).where(keys_not_null("date")).groupBy("date")
             .agg(M.count_sum("clicks").alias("total_clicks"),
                  M.count_sum("impressions").alias("total_impressions")))
    return daily.withColumn("daily_ctr", M.ctr("total_clicks", "total_impressions"))


def campaign_summary(df: DataFrame) -> DataFrame | None:
    """(client_id, campaign_id) -> total_spend, total_clicks,
    total_impressions (AG5). All five inputs are checked (D12)."""
    if not has_columns(df, "client_id", "campaign_id", "spend_usd", "clicks", "impressions"):
        return None
    keys = ["client_id", "campaign_id"]
    return (df.where(keys_not_null(*keys)).groupBy(*keys)
            .agg(M.money_sum("spend_usd").alias("total_spend"),
                 M.count_sum("clicks").alias("total_clicks"),
                 M.count_sum("impressions").alias("total_impressions")))


# fixed values: report file names, their sort keys, and whether the row count
# has a proven bound (one row per platform) so one output file is safe
REPORTS = {
    "daily_client_spend_report": (daily_client_spend, ["date", "client_id"], False),
    "total_clicks_by_platform_report": (clicks_by_platform, ["platform"], True),
    "ctr_trends_report": (ctr_trends, ["date"], False),
    "campaign_summary_report": (campaign_summary, ["client_id", "campaign_id"], False),
}
