"""Channel comparison ("lift") report (AG6, AG7, MTH6, MTH7, SRT1, PRD1)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions import metrics as M

log = logging.getLogger(__name__)

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def with_conversion_flag(df: DataFrame, conversion_column: str = S.ATTRIBUTED_REVENUE_COL) -> DataFrame:
    """``is_converted`` = conversion > 0 (PRD1)."""
    return df.withColumn("is_converted", F.col(conversion_column) > 0)


def channel_lift(df: DataFrame, conversion_column: str = S.ATTRIBUTED_REVENUE_COL) -> DataFrame | None:
    """Per platform: revenue, spend, clicks, impressions, touchpoints,
    revenue per touchpoint and ROI (%), highest revenue per touchpoint
    first (ties by platform). None when the conversion or platform column
    is missing.

    Five groups at most per task after the partial aggregate, so the
    shuffle is tiny whatever the input size or skew.
    """
    if conversion_column not in df.columns:
        log.error("conversion column %s not found", conversion_column)
        return None
    if "platform" not in df.columns:
        log.error("platform column missing")
        return None
    conv_type = df.schema[conversion_column].dataType
    conv_sum = (M.count_sum(conversion_column) if isinstance(conv_type, INTEGRAL)
                else M.money_sum(conversion_column))
    per_channel = (df.where(F.col("platform").isNotNull()).groupBy("platform").agg(
        conv_sum.alias("total_attributed_revenue"),
        M.money_sum("spend_usd").alias("total_spend"),
        M.count_sum("clicks").alias("total_clicks"),
        M.count_sum("impressions").alias("total_impressions"),
        F.count("platform").alias("total_touchpoints"),
    ))
    return lift_ratios(per_channel)


def lift_ratios(per_channel: DataFrame) -> DataFrame:
    """The ratios of each channel's sums, in order (MTH6, MTH7, SRT1)."""
    return (per_channel.withColumns({
        "revenue_per_touchpoint": M.guarded_ratio("total_attributed_revenue", "total_touchpoints"),
        "attributed_roi": M.roi_percent("total_attributed_revenue", "total_spend"),
    }).orderBy(F.col("revenue_per_touchpoint").desc(), F.col("platform")))
