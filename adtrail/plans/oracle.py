"""Independent SQL statement of every registered query, for DuckDB.

The text below restates the bindings and the transformation rules in
plain SQL over the driver's tables; it shares no code with the Spark
side. Money sums go through DECIMAL(38,8) exactly as on the Spark side,
counts are BIGINT, and every output column carries the same alias as the
Spark query.
"""

from __future__ import annotations

from adtrail.plans import registry as RG
from adtrail.plans.exports import ORACLE_SQL as EXPORT_SQL

_CHANNEL_OF_PLATFORM = """CASE {p} WHEN 'google_ads' THEN 'google_ads' WHEN 'facebook_ads' THEN 'facebook'
        WHEN 'email_campaigns' THEN 'email' WHEN 'web_traffic' THEN 'organic' END"""


def _money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,8))) AS DOUBLE)"


def _count(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def _ratio(num: str, den: str, scale: str | None = None) -> str:
    r = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"
    if scale:
        r = f"{r} * {scale}"
    return f"CASE WHEN CAST({den} AS DOUBLE) > 0 THEN {r} ELSE {D0} END"


def _to_count(x: str) -> str:
    return f"COALESCE(TRY_CAST(TRUNC(TRY_CAST({x} AS DOUBLE)) AS BIGINT), CAST(0 AS BIGINT))"


def _seconds(x: str) -> str:
    part = lambda i: f"TRY_CAST(string_split({x}, ':')[{i}] AS BIGINT)"
    return (f"COALESCE(CASE len(string_split({x}, ':')) "
            f"WHEN 3 THEN {part(1)} * 3600 + {part(2)} * 60 + {part(3)} "
            f"WHEN 2 THEN {part(1)} * 60 + {part(2)} END, CAST(0 AS BIGINT))")


D0 = "CAST(0.0 AS DOUBLE)"


_CLIENT = """CASE WHEN o_custkey % 37 = 5 THEN NULL WHEN o_custkey % 10 = 0 THEN 'C0' || CAST(o_custkey AS VARCHAR)
                 ELSE 'C' || CAST(o_custkey AS VARCHAR) END"""
_DATE = "CASE WHEN o_orderkey % 29 <> 3 THEN o_orderdate END"

_CTES = f"""
lo AS (
    SELECT l.*, {_CLIENT} AS cid, {_DATE} AS day
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
raw_google AS (
    SELECT CASE WHEN l_discount > 0 THEN CAST(l_partkey AS VARCHAR) END AS campaign_id,
           cid AS client_id, day AS date,
           l_quantity AS clicks, l_quantity * (l_linenumber - 1) * 20 AS impressions,
           l_extendedprice AS cost_usd, l_linestatus AS device_type, CAST(NULL AS VARCHAR) AS geo
    FROM lo WHERE l_returnflag = 'N'),
raw_facebook AS (
    SELECT CASE WHEN l_discount > 0 THEN CAST(l_partkey AS VARCHAR) END AS fb_campaign_id,
           cid AS client, day AS date,
           l_quantity AS clicks, l_quantity * (l_linenumber - 1) * 20 AS reach,
           l_extendedprice AS spend, l_linestatus AS platform, CAST(NULL AS VARCHAR) AS geo
    FROM lo WHERE l_returnflag = 'R'),
raw_email AS (
    SELECT CASE WHEN l_discount > 0 THEN CAST(l_partkey AS VARCHAR) END AS email_id,
           cid AS client_id, day AS date,
           l_quantity * 1000 AS emails_sent, l_discount AS open_rate, l_tax AS click_rate,
           CAST(NULL AS VARCHAR) AS subject_line
    FROM lo WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
raw_web AS (
    SELECT cid AS client_id, day AS date,
           l_quantity * 20 AS pageviews, l_quantity * 10 AS sessions, l_discount AS bounce_rate,
           CASE WHEN l_linenumber <= 4
                  THEN CAST(l_linenumber - 1 AS VARCHAR) || ':' || CAST(CAST(l_quantity AS BIGINT) % 60 AS VARCHAR)
                       || ':' || CAST(l_suppkey % 60 AS VARCHAR)
                WHEN l_linenumber <= 6
                  THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ':' || CAST(l_suppkey % 60 AS VARCHAR)
                ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'm' || CAST(l_suppkey % 60 AS VARCHAR) || 's'
           END AS avg_session_duration
    FROM lo WHERE l_returnflag = 'A' AND l_linestatus = 'O'),
raw_revenue AS (
    SELECT {_CLIENT} AS client_id, {_DATE} AS date,
           CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'google_ads' WHEN '2' THEN 'facebook'
                WHEN '3' THEN 'email' WHEN '4' THEN 'organic' ELSE 'other' END AS channel,
           CASE WHEN o_orderkey % 19 <> 2 THEN o_totalprice END AS attributed_revenue
    FROM orders),
raw_clients AS (
    SELECT 'C' || CAST(c_custkey AS VARCHAR) AS client_id, c_name AS name, c_mktsegment AS industry,
           n_name AS account_manager,
           CAST(1990 + c_custkey % 8 AS VARCHAR) || '-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0')
             || '-' || lpad(CAST(1 + c_custkey % 31 AS VARCHAR), 2, '0') AS signup_text
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
in_clients AS (
    SELECT client_id, name, industry, account_manager, TRY_CAST(signup_text AS TIMESTAMP) AS signup_date
    FROM raw_clients),
std_google AS (
    SELECT campaign_id, client_id, date, clicks, impressions, cost_usd AS spend_usd, device_type, geo,
           'google_ads' AS platform FROM raw_google),
std_facebook AS (
    SELECT fb_campaign_id AS campaign_id, client AS client_id, date, clicks, reach AS impressions,
           spend AS spend_usd, platform AS platform_detail, geo, 'facebook_ads' AS platform FROM raw_facebook),
std_email AS (
    SELECT email_id AS campaign_id, client_id, date, emails_sent, open_rate, click_rate, subject_line,
           'email_campaigns' AS platform FROM raw_email),
std_web AS (
    SELECT client_id, date, pageviews, sessions, bounce_rate,
           avg_session_duration AS avg_session_duration_str, 'web_traffic' AS platform FROM raw_web),
std_revenue AS (
    SELECT client_id, date, channel, attributed_revenue AS attributed_revenue_usd, 'revenue' AS platform
    FROM raw_revenue),
cl_google AS (
    SELECT campaign_id, client_id, date, {_to_count('clicks')} AS clicks,
           {_to_count('impressions')} AS impressions, spend_usd, device_type, geo, platform FROM std_google),
cl_facebook AS (
    SELECT campaign_id, client_id, date, {_to_count('clicks')} AS clicks,
           {_to_count('impressions')} AS impressions, spend_usd, platform_detail, geo, platform FROM std_facebook),
cl_email AS (
    SELECT campaign_id, client_id, date, {_to_count('emails_sent')} AS emails_sent, open_rate, click_rate,
           subject_line, platform FROM std_email),
cl_web AS (
    SELECT client_id, date, {_to_count('pageviews')} AS pageviews, {_to_count('sessions')} AS sessions,
           bounce_rate, platform,
           {_seconds('avg_session_duration_str')} AS avg_session_duration_seconds
    FROM std_web),
cl_revenue AS (SELECT client_id, date, channel, attributed_revenue_usd, platform FROM std_revenue),
cl_clients AS (SELECT client_id, name, industry, account_manager, signup_date, 'clients' AS platform FROM in_clients),
facts AS (
    SELECT client_id, date, platform, COALESCE(campaign_id, 'Unknown') AS campaign_id,
           COALESCE(device_type, 'Unknown') AS device_type, COALESCE(geo, 'Unknown') AS geo,
           clicks, impressions, COALESCE(spend_usd, 0.0) AS spend_usd,
           CAST(0 AS BIGINT) AS emails_sent, {D0} AS open_rate, {D0} AS click_rate, 'Unknown' AS subject_line,
           CAST(0 AS BIGINT) AS pageviews, CAST(0 AS BIGINT) AS sessions, {D0} AS bounce_rate,
           CAST(0 AS BIGINT) AS avg_session_duration_seconds, 'Unknown' AS platform_detail
    FROM cl_google
    UNION ALL
    SELECT client_id, date, platform, COALESCE(campaign_id, 'Unknown'), 'Unknown', COALESCE(geo, 'Unknown'),
           clicks, impressions, COALESCE(spend_usd, 0.0),
           0, {D0}, {D0}, 'Unknown', 0, 0, {D0}, 0, COALESCE(platform_detail, 'Unknown')
    FROM cl_facebook
    UNION ALL
    SELECT client_id, date, platform, COALESCE(campaign_id, 'Unknown'), 'Unknown', 'Unknown',
           0, 0, {D0}, emails_sent, COALESCE(open_rate, 0.0), COALESCE(click_rate, 0.0),
           COALESCE(subject_line, 'Unknown'), 0, 0, {D0}, 0, 'Unknown'
    FROM cl_email
    UNION ALL
    SELECT client_id, date, platform, 'Unknown', 'Unknown', 'Unknown', 0, 0, {D0}, 0, {D0}, {D0}, 'Unknown',
           pageviews, sessions, COALESCE(bounce_rate, 0.0), avg_session_duration_seconds, 'Unknown'
    FROM cl_web
    UNION ALL
    SELECT client_id, date, platform, 'Unknown', 'Unknown', 'Unknown', 0, 0, {D0}, 0, {D0}, {D0}, 'Unknown',
           0, 0, {D0}, 0, 'Unknown'
    FROM cl_revenue),
joined AS (
    SELECT f.*, COALESCE(c.name, 'Unknown') AS name, COALESCE(c.industry, 'Unknown') AS industry,
           COALESCE(c.account_manager, 'Unknown') AS account_manager, c.signup_date
    FROM facts f LEFT JOIN cl_clients c ON f.client_id = c.client_id),
metrics AS (
    SELECT *, {_ratio('clicks', 'impressions', '100')} AS ctr,
           {_ratio('spend_usd', 'clicks')} AS cpc_usd,
           {_ratio('spend_usd', 'impressions', '1000')} AS cpm_usd,
           clicks + emails_sent + sessions AS total_interactions
    FROM joined),
rev_daily AS (
    SELECT client_id, date, channel, {_money('COALESCE(attributed_revenue_usd, 0.0)')}
             AS attributed_revenue_from_source_usd
    FROM cl_revenue
    WHERE client_id IS NOT NULL AND date IS NOT NULL AND channel IS NOT NULL
    GROUP BY client_id, date, channel),
final AS (
    SELECT m.*, COALESCE(r.attributed_revenue_from_source_usd, {D0}) AS attributed_revenue_from_source_usd,
           {D0} AS attributed_revenue_model_usd
    FROM metrics m LEFT JOIN rev_daily r
      ON m.client_id = r.client_id AND m.date = r.date
     AND {_CHANNEL_OF_PLATFORM.format(p='m.platform')} = r.channel),
fin AS (SELECT * FROM final WHERE date IS NOT NULL)
"""


def _q(body: str) -> str:
    return f"WITH {_CTES.strip()}\n{body.strip()}"


_QUALITY = " UNION ALL ".join(
    f"SELECT '{src}' AS source, '{col}' AS \"column\", "
    f"CAST(count(*) FILTER (WHERE {expr} IS NULL) AS BIGINT) AS null_count FROM {tbl}"
    for src, tbl, cols in [
        ("google_ads", "raw_google", ["date", "clicks", "impressions", "cost_usd"]),
        ("facebook_ads", "raw_facebook", ["date", "clicks", "reach", "spend"]),
        ("email_campaigns", "raw_email", ["date", "emails_sent", "open_rate", "click_rate"]),
        ("web_traffic", "raw_web", ["date", "pageviews", "sessions", "bounce_rate"]),
        ("revenue", "raw_revenue", ["date", "attributed_revenue"]),
        ("clients", "in_clients", ["signup_date"]),
    ]
    for col, expr in [(c, c) for c in cols])

_MEANS = ", ".join(
    f"round(avg(CASE WHEN isnan(CAST({src} AS DOUBLE)) THEN NULL ELSE CAST({src} AS DOUBLE) END), "
    f"{RG.MEAN_DECIMALS}) AS {out}"
    for out, src in [("avg_ctr", "ctr"), ("avg_cpc_usd", "cpc_usd"), ("avg_cpm_usd", "cpm_usd"),
                     ("avg_open_rate", "open_rate"), ("avg_click_rate", "click_rate"),
                     ("avg_bounce_rate", "bounce_rate"), ("avg_total_interactions", "total_interactions")])

_FINAL_COLS = """client_id, date, platform, campaign_id, device_type, geo, clicks, impressions, spend_usd,
    emails_sent, open_rate, click_rate, subject_line, pageviews, sessions, bounce_rate,
    avg_session_duration_seconds, platform_detail, name, industry, account_manager, signup_date,
    ctr, cpc_usd, cpm_usd, total_interactions"""

_PREVIEW_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST" for c in
    ["date", "client_id", "platform", "campaign_id", "device_type", "geo", "clicks", "impressions",
     "spend_usd", "emails_sent", "open_rate", "click_rate", "subject_line", "pageviews", "sessions",
     "bounce_rate", "avg_session_duration_seconds", "platform_detail", "name", "industry",
     "account_manager", "signup_date", "ctr", "cpc_usd", "cpm_usd", "total_interactions",
     "attributed_revenue_from_source_usd", "attributed_revenue_model_usd"])

ORACLE_SQL: dict[str, str] = {
    "std_google": _q("SELECT * FROM std_google"),
    "std_facebook": _q("SELECT * FROM std_facebook"),
    "std_email": _q("SELECT * FROM std_email"),
    "std_web": _q("SELECT * FROM std_web"),
    "std_revenue": _q("SELECT * FROM std_revenue"),
    "enforce_types": _q("SELECT * FROM cl_google"),
    "clean_clients": _q("SELECT * FROM cl_clients"),
    "duration_seconds": _q(f"""
        SELECT client_id, date, avg_session_duration,
               {_seconds('avg_session_duration')} AS avg_session_duration_seconds
        FROM raw_web"""),
    "parse_quality": _q(_QUALITY),
    "union_facts": _q("SELECT * FROM facts"),
    "join_clients": _q("SELECT * FROM joined"),
    "key_metrics": _q("SELECT * FROM metrics"),
    "summary_means": _q(f"SELECT {_MEANS} FROM metrics"),
    "revenue_daily_channel": _q("SELECT * FROM rev_daily"),
    "stream_revenue_daily": _q("SELECT * FROM rev_daily"),
    "final_round_trip": _q("SELECT * FROM fin"),
    "stream_web_daily": _q("""
        SELECT date, CAST(SUM(sessions) AS BIGINT) AS total_sessions, CAST(SUM(pageviews) AS BIGINT) AS total_pageviews
        FROM (SELECT TRY_CAST(strftime(ts, '%Y-%m-%d') AS TIMESTAMP) AS date,
                     CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS pageviews,
                     CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS sessions
              FROM events)
        WHERE date IS NOT NULL GROUP BY date"""),
    "kpis_display": _q(f"""
        SELECT '$' || format('{{:,.2f}}', COALESCE({_money('spend_usd')}, 0.0)) AS total_spend_usd,
               format('{{:,}}', COALESCE({_count('clicks')}, 0)) AS total_clicks,
               format('{{:,}}', COALESCE({_count('impressions')}, 0)) AS total_impressions,
               format('{{:,}}', COALESCE({_count('sessions')}, 0)) AS total_sessions,
               format('{{:,}}', COALESCE({_count('emails_sent')}, 0)) AS total_emails_sent,
               '$' || format('{{:,.2f}}', COALESCE({_money('attributed_revenue_from_source_usd')}, 0.0))
                   AS total_attributed_revenue_usd
        FROM fin"""),
    "platform_channel": _q(f"""
        SELECT platform, {_CHANNEL_OF_PLATFORM.format(p='platform')} AS channel,
               count(*) AS touchpoints
        FROM facts GROUP BY ALL"""),
    "attribution": _q("SELECT * FROM final"),
    "refreshed_months": _q("SELECT * FROM final"),
    "attribution_no_revenue": _q(f"""
        SELECT {_FINAL_COLS}, {D0} AS attributed_revenue_from_source_usd, {D0} AS attributed_revenue_model_usd
        FROM metrics"""),
    "daily_client_spend": _q(f"""
        SELECT date, client_id, {_money('spend_usd')} AS spend_usd
        FROM fin WHERE date IS NOT NULL AND client_id IS NOT NULL GROUP BY date, client_id"""),
    "clicks_by_platform": _q(f"""
        SELECT platform, {_count('clicks')} AS clicks FROM fin WHERE platform IS NOT NULL GROUP BY platform"""),
    "ctr_trends": _q(f"""
        SELECT date, total_clicks, total_impressions,
               {_ratio('total_clicks', 'total_impressions', '100')} AS daily_ctr
        FROM (SELECT date, {_count('clicks')} AS total_clicks, {_count('impressions')} AS total_impressions
              FROM fin WHERE platform IN ('google_ads', 'facebook_ads') AND date IS NOT NULL
              GROUP BY date)"""),
    "campaign_summary": _q(f"""
        SELECT client_id, campaign_id, {_money('spend_usd')} AS total_spend,
               {_count('clicks')} AS total_clicks, {_count('impressions')} AS total_impressions
        FROM fin WHERE client_id IS NOT NULL AND campaign_id IS NOT NULL
        GROUP BY client_id, campaign_id"""),
    "channel_lift": _q(f"""
        SELECT *, {_ratio('total_attributed_revenue', 'total_touchpoints')} AS revenue_per_touchpoint,
               CASE WHEN total_spend > 0 THEN (total_attributed_revenue - total_spend) / total_spend * 100.0
                    ELSE {D0} END AS attributed_roi
        FROM (SELECT platform, {_money('attributed_revenue_from_source_usd')} AS total_attributed_revenue,
                     {_money('spend_usd')} AS total_spend, {_count('clicks')} AS total_clicks,
                     {_count('impressions')} AS total_impressions, count(platform) AS total_touchpoints
              FROM fin WHERE platform IS NOT NULL GROUP BY platform)"""),
    "kpis": _q(f"""
        SELECT COALESCE({_money('spend_usd')}, 0.0) AS total_spend_usd,
               COALESCE({_count('clicks')}, 0) AS total_clicks,
               COALESCE({_count('impressions')}, 0) AS total_impressions,
               COALESCE({_count('sessions')}, 0) AS total_sessions,
               COALESCE({_count('emails_sent')}, 0) AS total_emails_sent,
               COALESCE({_money('attributed_revenue_from_source_usd')}, 0.0) AS total_attributed_revenue_usd
        FROM fin"""),
    "spend_by_platform": _q(f"""
        SELECT platform, {_money('spend_usd')} AS spend_usd FROM fin WHERE platform IS NOT NULL GROUP BY platform"""),
    "clicks_over_time": _q(f"""
        SELECT date, {_count('clicks')} AS clicks FROM fin WHERE date IS NOT NULL GROUP BY date"""),
    "ctr_by_platform": _q(f"""
        SELECT platform, total_clicks, total_impressions,
               {_ratio('total_clicks', 'total_impressions', '100')} AS aggregate_ctr
        FROM (SELECT platform, {_count('clicks')} AS total_clicks, {_count('impressions')} AS total_impressions
              FROM fin WHERE platform IN ('google_ads', 'facebook_ads') GROUP BY platform)"""),
    "web_daily": _q(f"""
        SELECT date, {_count('sessions')} AS total_sessions, {_count('pageviews')} AS total_pageviews
        FROM fin WHERE platform = 'web_traffic' AND date IS NOT NULL GROUP BY date"""),
    "revenue_over_time": _q(f"""
        SELECT * FROM (
            SELECT date, platform, {_money('attributed_revenue_from_source_usd')} AS attributed_revenue_from_source_usd
            FROM fin WHERE date IS NOT NULL AND platform IS NOT NULL GROUP BY date, platform)
        WHERE attributed_revenue_from_source_usd > 0"""),
    "date_bounds": _q("""
        SELECT min(date) AS min_date, max(date) AS max_date,
               strftime(min(date), '%Y-%m-%d') AS min_label, strftime(max(date), '%Y-%m-%d') AS max_label
        FROM fin"""),
    "distinct_clients": _q("SELECT DISTINCT client_id FROM fin WHERE client_id IS NOT NULL"),
    "distinct_platforms": _q("SELECT DISTINCT platform FROM fin WHERE platform IS NOT NULL"),
    "platform_options": _q("""
        SELECT 'All' AS option UNION ALL
        SELECT DISTINCT CAST(platform AS VARCHAR) FROM fin WHERE platform IS NOT NULL"""),
    "filter_client": _q(f"SELECT * FROM fin WHERE client_id = '{RG.FILTER_CLIENT}'"),
    "filter_platform": _q(f"SELECT * FROM fin WHERE platform = '{RG.FILTER_PLATFORM}'"),
    "filter_range": _q(f"""
        SELECT * FROM fin WHERE date BETWEEN TIMESTAMP '{RG.FILTER_RANGE[0]}' AND TIMESTAMP '{RG.FILTER_RANGE[1]}'"""),
    "filtered_ctr_trends": _q(f"""
        SELECT date, total_clicks, total_impressions,
               {_ratio('total_clicks', 'total_impressions', '100')} AS daily_ctr
        FROM (SELECT date, {_count('clicks')} AS total_clicks, {_count('impressions')} AS total_impressions
              FROM fin
              WHERE platform = '{RG.FILTER_PLATFORM}'
                AND date BETWEEN TIMESTAMP '{RG.FILTER_YEAR[0]}' AND TIMESTAMP '{RG.FILTER_YEAR[1]}'
                AND platform IN ('google_ads', 'facebook_ads') AND date IS NOT NULL
              GROUP BY date)"""),
    "filter_day": _q(f"SELECT * FROM fin WHERE date = TIMESTAMP '{RG.FILTER_DAY[0]}'"),
    "preview": _q(f"SELECT * FROM fin ORDER BY {_PREVIEW_ORDER} LIMIT 5"),
    "next_client_id": _q("""
        SELECT CAST(CASE WHEN count(*) > 0 AND count(*) FILTER (WHERE TRY_CAST(replace(client_id, 'C', '') AS BIGINT) IS NULL) = 0
                         THEN max(TRY_CAST(replace(client_id, 'C', '') AS BIGINT)) + 1 ELSE 101 END AS BIGINT)
               AS next_client_number
        FROM in_clients"""),
    "campaigns_per_client": _q("""
        SELECT DISTINCT client_id, platform, campaign_id
        FROM (SELECT client_id, platform, campaign_id FROM cl_google UNION ALL
              SELECT client_id, platform, campaign_id FROM cl_facebook UNION ALL
              SELECT client_id, platform, campaign_id FROM cl_email) c
        WHERE campaign_id IS NOT NULL AND EXISTS (SELECT 1 FROM cl_clients k WHERE k.client_id = c.client_id)"""),
    "report_files": _q(f"""
        SELECT client_id, campaign_id, {_money('spend_usd')} AS total_spend, {_count('clicks')} AS total_clicks,
               {_count('impressions')} AS total_impressions
        FROM fin WHERE client_id IS NOT NULL AND campaign_id IS NOT NULL GROUP BY client_id, campaign_id"""),
    "appended_clients": _q("""
        SELECT client_id, name, signup_date FROM in_clients WHERE right(client_id, 1) < '5'
        UNION ALL
        SELECT 'C' || (row_number() OVER (ORDER BY name) + (SELECT max(CAST(replace(client_id, 'C', '') AS BIGINT))
                       FROM in_clients WHERE right(client_id, 1) < '5')), name, signup_date
        FROM in_clients WHERE right(client_id, 1) >= '5'"""),
    "converted_touchpoints": _q("""
        SELECT platform, attributed_revenue_from_source_usd > 0 AS is_converted, count(*) AS touchpoints FROM fin GROUP BY 1, 2"""),
    "skipped_reports": _q("""
        SELECT 'daily_client_spend_report' AS report, count(DISTINCT (date, client_id)) AS groups
        FROM fin WHERE date IS NOT NULL AND client_id IS NOT NULL"""),
    "clients_without_facts": _q("SELECT * FROM joined WHERE false"),
    "attribution_invalid_revenue": _q(f"""
        SELECT *, {D0} AS attributed_revenue_from_source_usd, {D0} AS attributed_revenue_model_usd FROM metrics"""),
    "rate_columns": _q(f"SELECT *, {D0} AS bounce_rate FROM cl_email"),
    "reports_one_pass": _q(" UNION ALL ".join(f"""
        SELECT '{report}' AS report, {date} AS date, {client} AS client_id, {platform} AS platform, {campaign} AS campaign_id,
               {_money('spend_usd')} AS total_spend, {_count('clicks')} AS total_clicks,
               {_count('impressions')} AS total_impressions,
               {_count("CASE WHEN platform IN ('google_ads', 'facebook_ads') THEN clicks END")} AS ad_clicks,
               {_count("CASE WHEN platform IN ('google_ads', 'facebook_ads') THEN impressions END")} AS ad_impressions,
               count(*) FILTER (WHERE platform IN ('google_ads', 'facebook_ads')) AS ad_rows,
               {_money('attributed_revenue_from_source_usd')} AS total_revenue, count(*) AS touchpoints
        FROM fin WHERE {keys} GROUP BY ALL""" for report, keys, date, client, platform, campaign in [
            ("daily_client_spend_report", "date IS NOT NULL AND client_id IS NOT NULL", "date", "client_id",
             "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
            ("total_clicks_by_platform_report", "platform IS NOT NULL", "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS VARCHAR)",
             "platform", "CAST(NULL AS VARCHAR)"),
            ("ctr_trends_report", "date IS NOT NULL", "date", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)",
             "CAST(NULL AS VARCHAR)"),
            ("campaign_summary_report", "client_id IS NOT NULL AND campaign_id IS NOT NULL", "CAST(NULL AS TIMESTAMP)",
             "client_id", "CAST(NULL AS VARCHAR)", "campaign_id")])),
    "published_range": _q(f"""
        SELECT * FROM fin WHERE date BETWEEN TIMESTAMP '{RG.FILTER_RANGE[0]}' AND TIMESTAMP '{RG.FILTER_RANGE[1]}'"""),
    "published_day": _q(f"SELECT * FROM fin WHERE date = TIMESTAMP '{RG.FILTER_DAY[0]}'"),
    "file_index": _q("SELECT CAST(count(*) AS BIGINT) AS rows, min(date) AS first_date, max(date) AS last_date FROM final"),
    "replaced_table": _q("SELECT * FROM fin"),
    "both_formats": _q("""
        SELECT format, platform, count(*) AS rows, CAST(sum(clicks) AS BIGINT) AS clicks
        FROM fin, (VALUES ('parquet'), ('table')) AS f(format) GROUP BY format, platform"""),
    **EXPORT_SQL,
}
