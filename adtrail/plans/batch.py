"""Batch composition: raw sources -> final table -> reports (ATT4, AG17,
ANA1, and the whole run).

``transform_sources`` builds one lazy plan; Catalyst sees the whole chain
(cleaning, union, the two joins, metrics), prunes columns into every scan
and plans the shuffles. Emptiness checks run only where the reference
stops early, and each reads at most one row of a source scan.

Reports re-read the written table instead of caching it, once for all of
them: one pruned columnar scan and one aggregate over grouping sets.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.operators.attribution import attach_revenue, daily_channel_revenue, usable_revenue
from adtrail.operators.facts import fact_branches, union_branches
from adtrail.operators.cleaning import clean_sources, is_blank
from adtrail.operators.joins import join_with_clients
from adtrail.operators.metrics import add_key_metrics
from adtrail.operators.reports import REPORTS
from adtrail.operators.summary import KEY_SETS, LIFT, available_reports, report_frames, summarize_reports
from adtrail.session import released_shuffles, scratch_folder
from adtrail.sinks import save_final, write_report_csv
from adtrail.sources.analytics import load_analytics
from adtrail.sources.files import essential_sources_present, ingest_all

log = logging.getLogger(__name__)


def build_final(cleaned: dict[str, DataFrame], salt_buckets: int = 0,
                deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
    """The 28-column final table from cleaned sources; None without a
    client dimension.

    Same rows as clean -> join clients -> metrics -> attribution, planned
    for the least shuffling:

    * revenue is aggregated once and joined once, before the client
      attributes and metrics exist, so the shuffled rows carry the 18 fact
      columns only; branches whose platform has no revenue channel (the
      revenue rows themselves) can never match and pass it by;
    * the client attributes (a broadcast when the dimension is small) and
      the per-row metrics are added after that.

    None of the steps depends on another: attribution keys on (client_id,
    date, platform), which the client join and the metrics do not change,
    and a fanned-out duplicate client copies the same revenue either way.
    ``deal`` shuffles the rows as they are to be written; the metrics, which
    follow from a row's own columns, are added behind it and not shuffled.
    """
    clients = cleaned.get(S.CLIENTS)
    if clients is None or is_blank(clients):
        log.error("clients are missing; cannot join")
        return None
    revenue = cleaned.get(S.REVENUE)
    usable = usable_revenue(revenue)
    schema = T.StructType(S.FACT_SCHEMA.fields + [T.StructField(S.ATTRIBUTED_REVENUE_COL, T.DoubleType())])
    branches = fact_branches(cleaned)
    mapped = [] if not usable else [df for p, df in branches.items() if p in S.PLATFORM_TO_CHANNEL]
    passing = [df.withColumn(S.ATTRIBUTED_REVENUE_COL, F.lit(0.0)) for p, df in branches.items()
               if not usable or p not in S.PLATFORM_TO_CHANNEL]
    if mapped:
        merged = attach_revenue(union_branches(mapped), daily_channel_revenue(revenue), salt_buckets)
        passing.insert(0, merged.select(*schema.names))
    facts = union_branches(passing, clients.sparkSession, schema)
    joined = join_with_clients(facts, clients, salt_buckets)
    if deal:
        joined = deal(joined)
    metrics = add_key_metrics(joined)
    return metrics.select(*S.METRICS_COLUMNS, S.ATTRIBUTED_REVENUE_COL,
                          F.lit(0.0).alias(S.ATTRIBUTED_MODEL_COL))


def transform_sources(sources: dict[str, DataFrame | None],
                      salt_buckets: int = 0) -> DataFrame | None:
    """clean -> stack facts -> join clients -> metrics -> attribution
    (ATT4). None when there is no client dimension. ``salt_buckets``
    turns on explicit salting of both joins (default: AQE skew splitting)."""
    return build_final(clean_sources(sources), salt_buckets)


def generate_summary_reports(spark: SparkSession, output_dir: str, data_path: str | None = None,
                             fmt: str = "parquet", table: str | None = S.FINAL_TABLE,
                             final: DataFrame | None = None, checked: bool = False,
                             lift_path: str | None = None) -> list[str]:
    """Load the final table once and write the four reports (AG17); with
    ``lift_path`` the channel lift too (ANA1).

    One pass over the table sums all reports; the sums are kept in the shared
    folder and each report is written from them. Nothing is written when the table
    is empty; the CTR report is skipped when there are no ad-platform rows; a report
    whose columns are missing is skipped. ``checked=True`` means the caller
    already knows ``final`` has rows. Returns the names of the reports written.
    """
    df = final if final is not None else load_analytics(spark, data_path, fmt, table)
    if df is None or (not checked and df.isEmpty()):
        log.warning("no data loaded for report generation; skipping reports")
        return []
    names = available_reports(df)
    for name in KEY_SETS:
        if name not in names and (name != LIFT or lift_path):
            log.warning("skipping %s: missing required columns", name)
    if not lift_path:
        names = [n for n in names if n != LIFT]
    if not names:
        return []
    with released_shuffles(spark):
        kept = kept_summary(spark, summarize_reports(df, reports=names))
        jobs = {}
        for name, report in report_frames(kept, names).items():
            if name == "ctr_trends_report" and report.isEmpty():
                log.warning("no ad-platform rows; skipping %s", name)
                continue
            if name == LIFT:  # at most one row per platform, in its own order
                jobs[name] = lambda r=report: write_report_csv(r, lift_path, single_file=True)
            else:
                _, keys, bounded = REPORTS[name]
                jobs[name] = lambda r=report, n=name, k=keys, b=bounded: write_report_csv(
                    r, os.path.join(output_dir, n), order_by=k, single_file=b)
        run_concurrently(jobs)
    return list(jobs)


def kept_summary(spark: SparkSession, summary: DataFrame) -> DataFrame:
    """The sums of all reports, written once to the shared folder, a folder per report."""
    path = scratch_folder(spark, "reports")
    summary.write.partitionBy("report").parquet(path)
    return spark.read.schema(summary.schema).parquet(path)


def run_concurrently(actions: dict, max_workers: int = 4) -> None:
    """Run independent Spark actions from a few driver threads so the
    scheduler can overlap their jobs; the first failure is raised."""
    if len(actions) <= 1:
        for fn in actions.values():
            fn()
        return
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        for future in [pool.submit(fn) for fn in actions.values()]:
            future.result()


def analyze(spark: SparkSession, written: dict | None, reports_dir: str,
            lift_path: str | None = None) -> list[str]:
    """Reports plus the channel lift CSV from the saved table (ANA1)."""
    if not written or (written.get("path") is None and written.get("table") is None):
        log.warning("nothing was saved; skipping analytics")
        return []
    final = load_analytics(spark, written.get("path"), written["format"], written.get("table"))
    if final is None or final.isEmpty():
        log.warning("final table missing or empty; skipping analytics")
        return []
    return generate_summary_reports(spark, reports_dir, final=final, checked=True,
                                    lift_path=lift_path or os.path.join(reports_dir, LIFT))


def quality_metrics() -> tuple[Callable[[DataFrame], DataFrame], Observation]:
    """Data-quality counts for the final table's write: total rows, rows
    without a date, facts whose client is unknown, rows carrying revenue.
    The function attaches them to a frame: ``observe`` computes them inside the
    write job itself -- no extra scan -- on top of the plan, so no pushdown is blocked."""
    obs = Observation("final_table_quality")
    return (lambda final: final.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNull()).alias("rows_without_date"),
        F.count_if(F.col("name") == F.lit(S.UNKNOWN)).alias("rows_with_unknown_client"),
        F.count_if(F.col(S.ATTRIBUTED_REVENUE_COL) > 0).alias("rows_with_revenue"),
    )), obs


def log_quality(metrics: dict) -> None:
    if metrics.get("rows_without_date"):
        log.warning("%d rows have no parseable date", metrics["rows_without_date"])
    if metrics.get("rows_with_unknown_client"):
        log.warning("%d rows reference clients missing from the client table",
                    metrics["rows_with_unknown_client"])


def run_batch(spark: SparkSession, paths: dict[str, str], output: dict, reports_dir: str,
              lift_path: str | None = None, read_options: dict | None = None,
              salt_buckets: int = 0) -> dict | None:
    """The whole batch: ingest -> gate -> transform -> save -> analyze.

    Returns the written output config with the observed quality counts
    under ``"quality"``, or None when the run stopped early."""
    data = ingest_all(spark, paths, **(read_options or {}))
    if not essential_sources_present(data):
        log.error("essential sources missing or empty; skipping the run")
        return None
    final = transform_sources(data, salt_buckets=salt_buckets)
    if final is None:
        log.error("transformation produced nothing; skipping load and analytics")
        return None
    observe, obs = quality_metrics()
    written = save_final(final, output, observe)
    if written is not None:
        written = {**written, "quality": obs.get}
        log_quality(written["quality"])
    analyze(spark, written, reports_dir, lift_path)
    return written
