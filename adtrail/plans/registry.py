"""Registered queries: one per operator group, each over the driver tables.

Every query builds on the raw sources derived from the given tables
(``adtrail.sources.bindings``), so its work grows with them. Each callable
takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose column names
match the SQL in ``adtrail.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail.functions.channels import channel_for_platform
from adtrail.functions.parsing import duration_seconds
from adtrail.operators import attribution as ATT
from adtrail.operators import explore as X
from adtrail.operators import ids as IDS
from adtrail.operators import reports as R
from adtrail.operators.cleaning import clean_source, clean_sources, enforce_types, standardize_columns
from adtrail.operators.facts import combine_facts
from adtrail.operators.joins import join_marketing_data
from adtrail.operators.lift import channel_lift
from adtrail.operators.metrics import add_key_metrics, ensure_rate_columns, summarize_metrics
from adtrail.operators.summary import summarize_reports
from adtrail.plans.batch import build_final
from adtrail.plans import stored
from adtrail.plans.exports import QUERIES as EXPORT_QUERIES
from adtrail.session import scratch_folder
from adtrail.sinks import write_parquet
from adtrail.sources.analytics import load_analytics, parse_quality
from adtrail.sources.bindings import (ingested_sources, raw_sources, revenue_projection, table,
                                     web_projection_from_events)
from adtrail.streaming.refresh import land_stream, read_landed

# fixed values: parameters of the filter queries (values present in the data)
FILTER_CLIENT = "C41"
FILTER_PLATFORM = S.GOOGLE_ADS
FILTER_RANGE = ("1997-01-01", "1997-03-31")
FILTER_DAY = ("1998-06-15",)
FILTER_YEAR = ("1997-01-01", "1997-12-31")
MEAN_DECIMALS = 6


_PLANS: dict[tuple[str, str, str], object] = {}


def _memo(spark: SparkSession, sf_dir: str, stage: str, build: Callable[[], object]):
    """Lazy plan objects are immutable, so the frames of a stage are built
    once per application and input folder and shared by later queries
    (no data is cached, only the analysed plan)."""
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _memo(spark, sf_dir, "sources", lambda: ingested_sources(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _memo(spark, sf_dir, "cleaned", lambda: clean_sources(_sources(spark, sf_dir)))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "joined", lambda: join_marketing_data(_cleaned(spark, sf_dir), check_empty=False))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "metrics", lambda: add_key_metrics(_joined(spark, sf_dir)))


def _attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo(spark, sf_dir, "attributed", lambda: build_final(_cleaned(spark, sf_dir)))


def final_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 28-column analytics table as read back for analysis: NULL-date
    rows dropped (SRC13)."""
    return _memo(spark, sf_dir, "final",
                 lambda: _attributed(spark, sf_dir).where(F.col("date").isNotNull()))


def _std(source: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return standardize_columns(_sources(spark, sf_dir)[source], source)
    q.__name__ = f"std_{source}"
    return q


def q_enforce_types(spark, sf_dir):
    return enforce_types(standardize_columns(_sources(spark, sf_dir)[S.GOOGLE_ADS], S.GOOGLE_ADS))


def q_clean_clients(spark, sf_dir):
    return _cleaned(spark, sf_dir)[S.CLIENTS]


def q_duration_seconds(spark, sf_dir):
    web = raw_sources(spark, sf_dir)[S.WEB_TRAFFIC]
    return web.select("client_id", "date", "avg_session_duration",
                      duration_seconds("avg_session_duration").alias(S.DURATION_SECONDS_COLUMN))


def q_parse_quality(spark, sf_dir):
    return parse_quality(_sources(spark, sf_dir))


def q_union_facts(spark, sf_dir):
    return combine_facts(_cleaned(spark, sf_dir), spark)


def q_join_clients(spark, sf_dir):
    return _joined(spark, sf_dir)


def q_key_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


def q_summary_means(spark, sf_dir):
    means = summarize_metrics(_metrics(spark, sf_dir))
    return means.select(*[F.round(c, MEAN_DECIMALS).alias(c) for c in means.columns])


def q_revenue_daily_channel(spark, sf_dir):
    return ATT.daily_channel_revenue(_cleaned(spark, sf_dir)[S.REVENUE])


def q_platform_channel(spark, sf_dir):
    facts = combine_facts(_cleaned(spark, sf_dir), spark)
    return (facts.groupBy("platform", channel_for_platform("platform").alias("channel"))
            .agg(F.count(F.lit(1)).alias("touchpoints")))


def q_attribution(spark, sf_dir):
    return _attributed(spark, sf_dir)


def q_attribution_no_revenue(spark, sf_dir):
    return ATT.perform_attribution(_metrics(spark, sf_dir), None)


def _over_final(fn):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(final_table(spark, sf_dir))
    q.__name__ = fn.__name__
    return q


def q_filter_client(spark, sf_dir):
    return X.apply_filters(final_table(spark, sf_dir), client=FILTER_CLIENT)


def q_filter_platform(spark, sf_dir):
    return X.apply_filters(final_table(spark, sf_dir), platform=FILTER_PLATFORM)


def q_filter_range(spark, sf_dir):
    return X.apply_filters(final_table(spark, sf_dir), date_range=FILTER_RANGE)


def q_filter_day(spark, sf_dir):
    return X.apply_filters(final_table(spark, sf_dir), date_range=FILTER_DAY)


def q_filtered_ctr_trends(spark, sf_dir):
    """The dashboard's composition: filters first, then the CTR chart."""
    view = X.apply_filters(final_table(spark, sf_dir), platform=FILTER_PLATFORM, date_range=FILTER_YEAR)
    return R.ctr_trends(view)


def q_distinct_clients(spark, sf_dir):
    return X.distinct_values(final_table(spark, sf_dir), "client_id")


def q_distinct_platforms(spark, sf_dir):
    return X.distinct_values(final_table(spark, sf_dir), "platform")


def q_platform_options(spark, sf_dir):
    return X.selector_options(final_table(spark, sf_dir), "platform")


def q_next_client_id(spark, sf_dir):
    return IDS.next_client_number(_sources(spark, sf_dir)[S.CLIENTS])


def q_kpis_display(spark, sf_dir):
    return X.format_key_totals(X.key_totals(final_table(spark, sf_dir)))


def q_final_round_trip(spark, sf_dir):
    """SNK2 then SRC12/SRC13: the final table written as parquet
    (partitioned by platform) under the shared checkpoint root, and read
    back for analysis."""
    path = scratch_folder(spark, "final")
    write_parquet(_attributed(spark, sf_dir), path)
    return load_analytics(spark, path, "parquet")


def _land_table_stream(spark: SparkSession, sf_dir: str, name: str,
                       projection: Callable[[DataFrame], DataFrame], source: str) -> DataFrame:
    """A driver table picked up by a glob-filtered file stream, projected
    to a raw source, landed idempotently under a fresh folder of the shared
    checkpoint root, and read back coerced like a file reader would."""
    schema = table(spark, sf_dir, name).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    root = scratch_folder(spark, "stream")
    land_stream(projection(stream), f"{root}/bronze/{source}", f"{root}/ckpt", None).awaitTermination()
    return read_landed(spark, root, [source])[source]


def q_stream_revenue_daily(spark, sf_dir):
    """STM1/STM2 on orders: daily channel revenue from landed rows."""
    landed = _land_table_stream(spark, sf_dir, "orders", revenue_projection, S.REVENUE)
    return ATT.daily_channel_revenue(clean_source(landed, S.REVENUE))


def q_stream_web_daily(spark, sf_dir):
    """STM1 on events: raw web traffic rows with text day stamps, landed,
    then the daily sessions / page views chart (AG12)."""
    landed = _land_table_stream(spark, sf_dir, "events", web_projection_from_events, S.WEB_TRAFFIC)
    return X.web_daily(clean_source(landed, S.WEB_TRAFFIC))


def q_campaigns_per_client(spark, sf_dir):
    """AG19 on the sources as cleaned: a missing campaign id is no campaign
    yet, and only clients of the client table count."""
    cleaned = _cleaned(spark, sf_dir)
    raw = [cleaned[s].select("client_id", "platform", "campaign_id") for s in IDS.CAMPAIGN_PLATFORMS]
    facts = raw[0].unionByName(raw[1]).unionByName(raw[2])
    known = cleaned[S.CLIENTS].select("client_id").distinct()
    return IDS.campaigns_per_client(facts.join(known, "client_id", "left_semi"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "std_google": _std(S.GOOGLE_ADS),
    "std_facebook": _std(S.FACEBOOK_ADS),
    "std_email": _std(S.EMAIL_CAMPAIGNS),
    "std_web": _std(S.WEB_TRAFFIC),
    "std_revenue": _std(S.REVENUE),
    "enforce_types": q_enforce_types,
    "clean_clients": q_clean_clients,
    "duration_seconds": q_duration_seconds,
    "parse_quality": q_parse_quality,
    "union_facts": q_union_facts,
    "join_clients": q_join_clients,
    "key_metrics": q_key_metrics,
    "summary_means": q_summary_means,
    "revenue_daily_channel": q_revenue_daily_channel,
    "platform_channel": q_platform_channel,
    "attribution": q_attribution,
    "attribution_no_revenue": q_attribution_no_revenue,
    "daily_client_spend": _over_final(R.daily_client_spend),
    "clicks_by_platform": _over_final(R.clicks_by_platform),
    "ctr_trends": _over_final(R.ctr_trends),
    "campaign_summary": _over_final(R.campaign_summary),
    "channel_lift": _over_final(channel_lift),
    "kpis": _over_final(X.key_totals),
    "spend_by_platform": _over_final(X.spend_by_platform),
    "clicks_over_time": _over_final(X.clicks_over_time),
    "ctr_by_platform": _over_final(X.ctr_by_platform),
    "web_daily": _over_final(X.web_daily),
    "revenue_over_time": _over_final(X.revenue_over_time),
    "date_bounds": _over_final(X.date_bounds),
    "distinct_clients": q_distinct_clients,
    "distinct_platforms": q_distinct_platforms,
    "platform_options": q_platform_options,
    "filter_client": q_filter_client,
    "filter_platform": q_filter_platform,
    "filter_range": q_filter_range,
    "filter_day": q_filter_day,
    "filtered_ctr_trends": q_filtered_ctr_trends,
    "preview": _over_final(lambda df: X.preview(df, ordered=True)),
    "next_client_id": q_next_client_id,
    "campaigns_per_client": q_campaigns_per_client,
    "stream_revenue_daily": q_stream_revenue_daily,
    "stream_web_daily": q_stream_web_daily,
    "kpis_display": q_kpis_display,
    "final_round_trip": q_final_round_trip,
    "report_files": lambda spark, sf_dir: stored.report_files(spark, _attributed(spark, sf_dir)),
    "appended_clients": lambda spark, sf_dir: stored.appended_clients(spark, _sources(spark, sf_dir)[S.CLIENTS]),
    "converted_touchpoints": _over_final(stored.converted_touchpoints),
    "skipped_reports": lambda spark, sf_dir: stored.skipped_reports(spark, final_table(spark, sf_dir)),
    "clients_without_facts": lambda spark, sf_dir: join_marketing_data({S.CLIENTS: _cleaned(spark, sf_dir)[S.CLIENTS]}),
    "attribution_invalid_revenue": lambda spark, sf_dir: ATT.perform_attribution(
        _metrics(spark, sf_dir), _cleaned(spark, sf_dir)[S.REVENUE].drop("attributed_revenue_usd")),
    "rate_columns": lambda spark, sf_dir: ensure_rate_columns(_cleaned(spark, sf_dir)[S.EMAIL_CAMPAIGNS]),
    "reports_one_pass": _over_final(summarize_reports),
    "published_range": lambda spark, sf_dir: stored.published(spark, _attributed(spark, sf_dir), FILTER_RANGE),
    "published_day": lambda spark, sf_dir: stored.published(spark, _attributed(spark, sf_dir), FILTER_DAY),
    "file_index": lambda spark, sf_dir: stored.file_index(spark, _attributed(spark, sf_dir)),
    "replaced_table": lambda spark, sf_dir: stored.replaced(spark, _attributed(spark, sf_dir)),
    "both_formats": lambda spark, sf_dir: stored.both_formats(spark, _attributed(spark, sf_dir)),
    **EXPORT_QUERIES,
}
