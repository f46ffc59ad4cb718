"""Column-level building blocks (all built-in Spark expressions)."""

from adtrail.functions.channels import channel_for_platform
from adtrail.functions.metrics import (count_sum, cpc, cpm, ctr, guarded_ratio, money_sum,
                                       nan_skipping_mean, roi_percent, total_interactions)
from adtrail.functions.parsing import (duration_seconds, na_to_null, strip_prefix, to_count,
                                       to_key, to_number, to_timestamp_ntz)

__all__ = [
    "channel_for_platform", "count_sum", "cpc", "cpm", "ctr", "guarded_ratio", "money_sum",
    "nan_skipping_mean", "roi_percent", "total_interactions", "duration_seconds", "na_to_null",
    "strip_prefix", "to_count", "to_key", "to_number", "to_timestamp_ntz",
]
