"""Registered queries over stored outputs: the final table written, replaced
and read back by the library's sinks and loaders."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import versions as V
from adtrail.operators.ids import number_new_clients
from adtrail.operators.lift import with_conversion_flag
from adtrail.operators.summary import available_reports, report_frames, summarize_reports
from adtrail.plans.batch import analyze
from adtrail.session import scratch_folder
from adtrail.sinks import append_batch, publish_parquet, replace_table, save_final, table_root
from adtrail.sources.analytics import load_analytics

DAY_FILES = 32  # ranges at least of the dataset from which one day is read


def _ranges(spark: SparkSession) -> int:
    """Ranges of a dataset: they follow the session's partitions, which follow the data, so that a task's rows fit its memory."""
    return max(DAY_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def published(spark: SparkSession, final: DataFrame, day: tuple) -> DataFrame:
    """SNK2, FLT3, FLT4: a first version, a second over it, and the days wanted
    from the second's files that hold them."""
    root = scratch_folder(spark, "published")
    publish_parquet(final.limit(0), root)
    publish_parquet(final, root, files=_ranges(spark))
    return load_analytics(spark, root, date_range=day)


def file_index(spark: SparkSession, final: DataFrame) -> DataFrame:
    """The file index of a version, summed up."""
    root = scratch_folder(spark, "indexed")
    publish_parquet(final, root, files=_ranges(spark))
    index = spark.read.parquet(f"{root}/{V.current_version(spark, root)}/{V.FILES}")
    return index.agg(F.sum("rows").alias("rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def replaced(spark: SparkSession, final: DataFrame) -> DataFrame:
    """SNK1, SRC12: a table replaced once and read back; it goes with the application."""
    name = f"final_{uuid.uuid4().hex[:12]}"
    replace_table(final.limit(0), name)
    replace_table(final, name)
    _forget(spark, name)
    return load_analytics(spark, fmt="table", table=name)


def both_formats(spark: SparkSession, final: DataFrame) -> DataFrame:
    """SNK4: rows and spend of each written format."""
    name, root = f"final_{uuid.uuid4().hex[:12]}", scratch_folder(spark, "formats")
    save_final(final, {"parquet": {"save": True, "path": root}, "table": {"save": True, "table": name}})
    _forget(spark, name)
    outputs = {"parquet": load_analytics(spark, root), "table": load_analytics(spark, fmt="table", table=name)}
    parts = [df.groupBy("platform").agg(F.count(F.lit(1)).alias("rows"), F.sum("clicks").alias("clicks"))
             .select(F.lit(fmt).alias("format"), "platform", "rows", "clicks") for fmt, df in outputs.items()]
    return parts[0].unionByName(parts[1])


def _forget(spark: SparkSession, table: str) -> None:
    """The table's folders go when the application ends; its name is of no use then."""
    p = spark._jvm.org.apache.hadoop.fs.Path(table_root(spark, table))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def report_files(spark: SparkSession, final: DataFrame) -> DataFrame:
    """SNK3, SRT2, ANA1: all reports written from a saved table, the campaign report read back."""
    root, out = scratch_folder(spark, "saved"), scratch_folder(spark, "report-files")
    written = save_final(final, {"parquet": {"save": True, "path": root}}, with_metrics=True)
    analyze(spark, written, out)
    return spark.read.option("header", True).schema(
        "client_id string, campaign_id string, total_spend double, total_clicks bigint, total_impressions bigint"
    ).csv(f"{out}/campaign_summary_report")


def appended_clients(spark: SparkSession, clients: DataFrame) -> DataFrame:
    """SNK5, SET2, AG18: a first batch of clients, and a second that gets the next ids as it is appended."""
    path = scratch_folder(spark, "clients")
    first = F.substring("client_id", -1, 1) < "5"
    append_batch(clients.where(first), path)
    held = spark.read.schema(clients.schema).parquet(path)
    append_batch(number_new_clients(clients.where(~first), held, ["name"]).select(*clients.columns), path)
    return spark.read.schema(clients.schema).parquet(path).select("client_id", "name", "signup_date")


def converted_touchpoints(final: DataFrame) -> DataFrame:
    """PRD1: touchpoints by platform and whether revenue was attributed."""
    return with_conversion_flag(final).groupBy("platform", "is_converted").agg(F.count(F.lit(1)).alias("touchpoints"))


def skipped_reports(spark: SparkSession, final: DataFrame) -> DataFrame:
    """FLT8: the rows of each report that can be made without clicks."""
    few = final.drop("clicks")
    names = available_reports(few)
    frames = report_frames(summarize_reports(few, reports=names), names)
    return reduce(DataFrame.unionAll, [df.agg(F.count(F.lit(1)).alias("groups")).select(F.lit(n).alias("report"), "groups")
                                       for n, df in frames.items()])
