"""All reports from one scan (AG17, ANA1).

The four summary reports and the channel lift group the same table by four key
sets. One aggregate over grouping sets computes them together: the table is read
once, every task sums its rows for all sets before the shuffle, and what is
shuffled is the reports themselves. ``report_frames`` then picks each report's rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions import metrics as M
from adtrail.operators.lift import INTEGRAL, lift_ratios

KEYS = ["date", "client_id", "platform", "campaign_id"]
LIFT = "cross_channel_lift_report"

# fixed values: each report's keys and the columns it needs
KEY_SETS = {
    "daily_client_spend_report": (["date", "client_id"], ["spend_usd"]),
    "total_clicks_by_platform_report": (["platform"], ["clicks"]),
    "ctr_trends_report": (["date"], ["clicks", "impressions", "platform"]),
    "campaign_summary_report": (["client_id", "campaign_id"], ["spend_usd", "clicks", "impressions"]),
    LIFT: (["platform"], ["spend_usd", "clicks", "impressions"]),
}


def available_reports(df: DataFrame, conversion_column: str = S.ATTRIBUTED_REVENUE_COL) -> list[str]:
    """Reports whose columns are all there (FLT8)."""
    held = set(df.columns)
    return [name for name, (keys, needs) in KEY_SETS.items()
            if {*keys, *needs} <= held and (name != LIFT or conversion_column in held)]


def _is_set(keys: list[str], of: list[str]) -> Column:
    """Whether a row belongs to the grouping set ``keys``, with no NULL key."""
    grouped = [F.grouping(k) == (0 if k in keys else 1) for k in of]
    return reduce(lambda a, b: a & b, grouped + [F.col(k).isNotNull() for k in keys])


def summarize_reports(df: DataFrame, conversion_column: str = S.ATTRIBUTED_REVENUE_COL,
                      reports: list[str] | None = None) -> DataFrame | None:
    """One row per report group: ``report`` (its key set's first report), the
    four keys, and the sums. None when no report can be made.

    The click-through trend counts ad platforms only, in sums of its own
    (``ad_rows`` tells whether a day has any)."""
    names = available_reports(df, conversion_column) if reports is None else reports
    if not names:
        return None
    used = {c for n in names for c in (*KEY_SETS[n][0], *KEY_SETS[n][1])} | ({conversion_column} if LIFT in names else set())
    sets: dict[tuple[str, ...], str] = {}
    for n in names:
        sets.setdefault(tuple(KEY_SETS[n][0]), n)
    keys = [k for k in KEYS if any(k in s for s in sets)]
    has = lambda c: F.col(c) if c in used else F.lit(None).cast("double")
    ad = F.col("_platform").isin(S.AD_PLATFORMS)
    conversion = has(conversion_column)
    whole = conversion_column in used and isinstance(df.schema[conversion_column].dataType, INTEGRAL)
    # the platform is a key of some sets and a condition in others, so it is read under two names
    rows = df.select(*sorted(used), *([F.col("platform").alias("_platform")] if "platform" in used else
                                      [F.lit(None).cast("string").alias("_platform")]))
    grouped = rows.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        M.money_sum(has("spend_usd")).alias("total_spend"),
        M.count_sum(has("clicks")).alias("total_clicks"),
        M.count_sum(has("impressions")).alias("total_impressions"),
        M.count_sum(F.when(ad, has("clicks"))).alias("ad_clicks"),
        M.count_sum(F.when(ad, has("impressions"))).alias("ad_impressions"),
        F.count_if(ad).alias("ad_rows"),
        (M.count_sum(conversion) if whole else M.money_sum(conversion)).alias("total_revenue"),
        F.count(F.lit(1)).alias("touchpoints"),
        *[_is_set(list(s), keys).alias(f"_is_{i}") for i, s in enumerate(sets)])
    report = F.coalesce(*[F.when(F.col(f"_is_{i}"), F.lit(n)) for i, n in enumerate(sets.values())])
    out = grouped.withColumn("report", report).where(F.col("report").isNotNull())
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return out.select("report", *[F.col(k) if k in keys else F.lit(None).cast(kinds.get(k, T.StringType())).alias(k) for k in KEYS],
                      "total_spend", "total_clicks", "total_impressions", "ad_clicks", "ad_impressions", "ad_rows",
                      "total_revenue", "touchpoints")


def report_frames(summary: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """Each report from the summary's rows, with the columns of the single reports."""
    first = {}
    for n in names:
        first.setdefault(tuple(KEY_SETS[n][0]), n)

    def rows(name: str) -> DataFrame:
        return summary.where(F.col("report") == first[tuple(KEY_SETS[name][0])])

    made = {
        "daily_client_spend_report": lambda r: r.select("date", "client_id", F.col("total_spend").alias("spend_usd")),
        "total_clicks_by_platform_report": lambda r: r.select("platform", F.col("total_clicks").alias("clicks")),
        "ctr_trends_report": lambda r: r.where("ad_rows > 0").select(
            "date", F.col("ad_clicks").alias("total_clicks"), F.col("ad_impressions").alias("total_impressions"),
            M.ctr("ad_clicks", "ad_impressions").alias("daily_ctr")),
        "campaign_summary_report": lambda r: r.select("client_id", "campaign_id", "total_spend", "total_clicks", "total_impressions"),
        LIFT: lambda r: lift_ratios(r.select(
            "platform", F.col("total_revenue").alias("total_attributed_revenue"), "total_spend", "total_clicks",
            "total_impressions", F.col("touchpoints").alias("total_touchpoints"))),
    }
    return {n: made[n](rows(n)) for n in names}
