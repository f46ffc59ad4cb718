"""DataFrame -> DataFrame operators of the channel-analytics model."""

from adtrail.operators.attribution import (attach_revenue, daily_channel_revenue, perform_attribution,
                                           usable_revenue)
from adtrail.operators.cleaning import (clean_source, clean_sources, enforce_types, is_blank,
                                        standardize_columns)
from adtrail.operators.explore import (apply_filters, clicks_over_time, ctr_by_platform, dashboard_views,
                                       date_bounds, distinct_values, format_key_totals, key_totals, preview,
                                       revenue_over_time, selector_options, spend_by_platform,
                                       web_daily)
from adtrail.operators.facts import align_to_schema, combine_facts, empty_frame, fill_fact_defaults
from adtrail.operators.ids import campaign_counts, campaigns_per_client, next_client_number
from adtrail.operators.joins import (client_dimension, join_marketing_data, join_with_clients,
                                     salted_left_join)
from adtrail.operators.lift import channel_lift, with_conversion_flag
from adtrail.operators.metrics import add_key_metrics, summarize_metrics
from adtrail.operators.reports import (campaign_summary, clicks_by_platform, ctr_trends,
                                       daily_client_spend)

__all__ = [
    "attach_revenue", "daily_channel_revenue", "perform_attribution", "usable_revenue",
    "clean_source", "clean_sources", "enforce_types", "is_blank",
    "standardize_columns", "apply_filters", "dashboard_views", "clicks_over_time", "ctr_by_platform", "date_bounds",
    "distinct_values", "format_key_totals", "key_totals", "preview", "revenue_over_time", "selector_options",
    "spend_by_platform", "web_daily", "align_to_schema", "combine_facts", "empty_frame",
    "fill_fact_defaults", "campaign_counts", "campaigns_per_client", "next_client_number",
    "client_dimension",
    "join_marketing_data", "join_with_clients", "salted_left_join", "channel_lift", "with_conversion_flag", "add_key_metrics",
    "summarize_metrics", "campaign_summary", "clicks_by_platform", "ctr_trends",
    "daily_client_spend",
]
