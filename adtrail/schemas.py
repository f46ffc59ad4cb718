"""Fixed vocabulary of the channel-analytics data model.

Everything in this module is a fixed value: column names, rename maps,
channel names and type choices that results depend on. They are stated
once, here, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: source names -------------------------------------------
GOOGLE_ADS = "google_ads"
FACEBOOK_ADS = "facebook_ads"
EMAIL_CAMPAIGNS = "email_campaigns"
WEB_TRAFFIC = "web_traffic"
REVENUE = "revenue"
CLIENTS = "clients"

FACT_SOURCES = [GOOGLE_ADS, FACEBOOK_ADS, EMAIL_CAMPAIGNS, WEB_TRAFFIC, REVENUE]
ALL_SOURCES = FACT_SOURCES + [CLIENTS]
# Sources that must be present and non-empty before the transform runs
# (revenue is optional).
ESSENTIAL_SOURCES = [GOOGLE_ADS, FACEBOOK_ADS, EMAIL_CAMPAIGNS, WEB_TRAFFIC, CLIENTS]
AD_PLATFORMS = [GOOGLE_ADS, FACEBOOK_ADS]

# --- fixed values: required raw columns per source -------------------------
REQUIRED_COLUMNS = {
    CLIENTS: ["client_id", "name", "industry", "account_manager", "signup_date"],
    GOOGLE_ADS: ["campaign_id", "client_id", "date", "clicks", "impressions",
                 "cost_usd", "device_type", "geo"],
    FACEBOOK_ADS: ["fb_campaign_id", "client", "date", "clicks", "reach",
                   "spend", "platform", "geo"],
    EMAIL_CAMPAIGNS: ["email_id", "client_id", "date", "emails_sent",
                      "open_rate", "click_rate", "subject_line"],
    WEB_TRAFFIC: ["client_id", "date", "pageviews", "sessions", "bounce_rate",
                  "avg_session_duration"],
    REVENUE: ["client_id", "date", "channel", "attributed_revenue"],
}

# Raw columns each reader coerces at ingestion (date first, then numerics).
INGEST_DATE_COLUMNS = {
    CLIENTS: ["signup_date"],
    GOOGLE_ADS: ["date"],
    FACEBOOK_ADS: ["date"],
    EMAIL_CAMPAIGNS: ["date"],
    WEB_TRAFFIC: ["date"],
    REVENUE: ["date"],
}
INGEST_NUMERIC_COLUMNS = {
    CLIENTS: [],
    GOOGLE_ADS: ["clicks", "impressions", "cost_usd"],
    FACEBOOK_ADS: ["clicks", "reach", "spend"],
    EMAIL_CAMPAIGNS: ["emails_sent", "open_rate", "click_rate"],
    WEB_TRAFFIC: ["pageviews", "sessions", "bounce_rate"],
    REVENUE: ["attributed_revenue"],
}

# --- fixed values: raw name -> canonical name, per source, in map order -----
COLUMN_MAPS = {
    GOOGLE_ADS: {
        "campaign_id": "campaign_id",
        "client_id": "client_id",
        "date": "date",
        "clicks": "clicks",
        "impressions": "impressions",
        "cost_usd": "spend_usd",
        "device_type": "device_type",
        "geo": "geo",
    },
    FACEBOOK_ADS: {
        "fb_campaign_id": "campaign_id",
        "client": "client_id",
        "date": "date",
        "clicks": "clicks",
        "reach": "impressions",
        "spend": "spend_usd",
        "platform": "platform_detail",
        "geo": "geo",
    },
    EMAIL_CAMPAIGNS: {
        "email_id": "campaign_id",
        "client_id": "client_id",
        "date": "date",
        "emails_sent": "emails_sent",
        "open_rate": "open_rate",
        "click_rate": "click_rate",
        "subject_line": "subject_line",
    },
    WEB_TRAFFIC: {
        "client_id": "client_id",
        "date": "date",
        "pageviews": "pageviews",
        "sessions": "sessions",
        "bounce_rate": "bounce_rate",
        "avg_session_duration": "avg_session_duration_str",
    },
    REVENUE: {
        "client_id": "client_id",
        "date": "date",
        "channel": "channel",
        "attributed_revenue": "attributed_revenue_usd",
    },
}

# --- fixed values: type enforcement targets (canonical names) ---------------
DATE_COLUMNS = ["date"]
COUNT_COLUMNS = ["clicks", "impressions", "emails_sent", "pageviews", "sessions"]
AMOUNT_COLUMNS = ["spend_usd", "open_rate", "click_rate", "bounce_rate",
                  "attributed_revenue_usd"]
TEXT_KEY_COLUMNS = ["client_id"]
DURATION_TEXT_COLUMN = "avg_session_duration_str"
DURATION_SECONDS_COLUMN = "avg_session_duration_seconds"

# --- fixed values: the 18-column fact table ---------------------------------
FACT_SCHEMA = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("platform", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("spend_usd", T.DoubleType()),
    T.StructField("emails_sent", T.LongType()),
    T.StructField("open_rate", T.DoubleType()),
    T.StructField("click_rate", T.DoubleType()),
    T.StructField("subject_line", T.StringType()),
    T.StructField("pageviews", T.LongType()),
    T.StructField("sessions", T.LongType()),
    T.StructField("bounce_rate", T.DoubleType()),
    T.StructField("avg_session_duration_seconds", T.LongType()),
    T.StructField("platform_detail", T.StringType()),
])
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]

# Defaults applied after the union.
FACT_ZERO_COLUMNS = ["clicks", "impressions", "spend_usd", "emails_sent",
                     "pageviews", "sessions", "avg_session_duration_seconds"]
FACT_RATE_COLUMNS = ["open_rate", "click_rate", "bounce_rate"]
FACT_TEXT_COLUMNS = ["campaign_id", "device_type", "geo", "subject_line",
                     "platform_detail"]
UNKNOWN = "Unknown"

# --- fixed values: the client dimension -------------------------------------
CLIENT_SCHEMA = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("account_manager", T.StringType()),
    T.StructField("signup_date", T.TimestampNTZType()),
])
CLIENT_COLUMNS = [f.name for f in CLIENT_SCHEMA.fields]
CLIENT_ATTRIBUTE_COLUMNS = CLIENT_COLUMNS[1:]

# --- fixed values: metrics ---------------------------------------------------
METRIC_INPUT_COLUMNS = ["clicks", "impressions", "spend_usd", "emails_sent", "sessions"]
METRIC_COLUMNS = ["ctr", "cpc_usd", "cpm_usd", "total_interactions"]
SUMMARY_COLUMNS = {
    "avg_ctr": "ctr",
    "avg_cpc_usd": "cpc_usd",
    "avg_cpm_usd": "cpm_usd",
    "avg_open_rate": "open_rate",
    "avg_click_rate": "click_rate",
    "avg_bounce_rate": "bounce_rate",
    "avg_total_interactions": "total_interactions",
}

# --- fixed values: attribution ----------------------------------------------
ATTRIBUTED_REVENUE_COL = "attributed_revenue_from_source_usd"
ATTRIBUTED_MODEL_COL = "attributed_revenue_model_usd"
PLATFORM_TO_CHANNEL = {
    "google_ads": "google_ads",
    "facebook_ads": "facebook",
    "email_campaigns": "email",
    "web_traffic": "organic",
}

JOINED_COLUMNS = FACT_COLUMNS + CLIENT_ATTRIBUTE_COLUMNS
METRICS_COLUMNS = JOINED_COLUMNS + METRIC_COLUMNS
FINAL_COLUMNS = METRICS_COLUMNS + [ATTRIBUTED_REVENUE_COL, ATTRIBUTED_MODEL_COL]
FINAL_TABLE = "marketing_analytics"

# --- fixed values: text tokens that mean "missing" in CSV exports ------------
# (the default missing-value markers of the common CSV readers)
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
             "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
             "None", "n/a", "nan", "null"]

# Money is summed as an exact decimal so results do not depend on task order;
# 38 digits leave room for any realistic total without overflow.
MONEY_TYPE = "decimal(38,8)"
