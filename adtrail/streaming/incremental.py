"""Refresh only the days that new files change (STM1).

``refresh`` rebuilds the whole final table after a landing. Here the table is a
folder partitioned by day (or month ...), and a refresh rebuilds the periods whose rows
can differ, by Spark's dynamic partition overwrite; the others' files stay as they are.

A final row is made from one fact, the revenue of its client, day and channel, and
its client's attributes. So new files change

* the periods of new facts and of new revenue (dates that cannot be read are a
  period of their own), and
* the periods in which a new client row's client has facts, whenever they came.

Cleaned rows are kept partitioned by batch and period: a refresh parses the new
batches only, and its scans prune the periods that stay.

Recovery: the newest batch that the table accounts for is noted per source, by one rename, after
the table's write has committed. A refresh that dies before that, even half-way through
the commit, is repeated whole by the next one: same batches, same periods, same rows. Until then
a reader may see some periods new and others old; who needs one state at
any moment uses ``refresh`` with its versioned folder. One refresh at a time per work folder.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail import versions as V
from adtrail.operators.cleaning import clean_source
from adtrail.operators.joins import client_dimension
from adtrail.plans.batch import build_final, run_concurrently
from adtrail.session import released_shuffles
from adtrail.sources.files import coerce_source, essential_sources_present
from adtrail.streaming.refresh import land_new_files

log = logging.getLogger(__name__)

PERIODS = ("day", "week", "month", "quarter", "year")


def _period(kind: str) -> Column:
    """The first day of a row's period; NULL without a date."""
    return F.to_date("date") if kind == "day" else F.trunc("date", kind)


def _within(kind: str, periods: list[str | None]) -> Column:
    """Rows of these periods, as a filter on the folder column alone. Periods are
    compared as text, as Spark names their folders."""
    held = F.col(kind).cast("string").isin([p for p in periods if p is not None])
    return held | F.col(kind).isNull() if None in periods else held


def _batches(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def _applied(spark: SparkSession, work_root: str, source: str) -> int:
    """The newest batch of a source that the table accounts for; -1 at first."""
    return int(V.current_version(spark, f"{work_root}/applied/{source}") or -1)


def _dealt(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows are dealt by period and AQE splits a period with much of the data among several tasks;
    ranges would need a sample, for which the whole plan of ``df`` runs once more."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def _spread_write(df: DataFrame, path: str, columns: list[str], mode: str, dealt: bool = False) -> None:
    """Write ``df`` by folder columns, dealt by them unless it is so (``dealt``). With mode
    ``dynamic`` only the partitions that ``df`` has rows of are replaced."""
    df = df if dealt else _dealt(df, columns)
    order = [*columns, *(c for c in ("platform", "date") if c in df.columns)]
    (df.sortWithinPartitions(*order).write.mode("overwrite")
     .option("partitionOverwriteMode", mode).partitionBy(*columns).parquet(path))


def _clean_schema(spark: SparkSession, source: str) -> T.StructType:
    """The columns and types of cleaned rows, which are fixed; so no file is opened to plan a scan."""
    if source == S.CLIENTS:
        return S.CLIENT_SCHEMA
    return clean_source(spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in S.COLUMN_MAPS[source]])), source).schema


def _keep_clean(spark: SparkSession, work_root: str, source: str, batch: int, kind: str, date_format: str | None) -> None:
    """Parse a landed batch and keep its cleaned rows by period; done again, it
    replaces the batch's folder by the same rows."""
    landed = spark.read.option("mergeSchema", True).parquet(f"{work_root}/bronze/{source}/batch={batch}")
    rows = clean_source(coerce_source(landed, source, date_format=date_format), source)
    path = f"{work_root}/clean/{source}/batch={batch}"
    if source == S.CLIENTS:
        client_dimension(rows).write.mode("overwrite").parquet(path)
        return
    schema = _clean_schema(spark, source)
    held = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.names])
    _spread_write(held.withColumn(kind, _period(kind)), path, [kind], "static")


def _clean(spark: SparkSession, work_root: str, source: str, kind: str) -> DataFrame:
    """Cleaned rows of all batches with the folder columns."""
    folders = [T.StructField("batch", T.IntegerType())] + ([] if source == S.CLIENTS else [T.StructField(kind, T.DateType())])
    return spark.read.schema(T.StructType(_clean_schema(spark, source).fields + folders)).parquet(f"{work_root}/clean/{source}")


def changed_periods(rows: dict[str, DataFrame], newer: dict[str, int], kind: str) -> list[str | None]:
    """Periods whose final rows can differ once the batches after ``newer`` count.

    Those of new facts and revenue come from folder names; only when clients have
    come, the client ids of facts kept before are read. One row a period is collected."""
    facts = {s: df for s, df in rows.items() if s != S.CLIENTS}
    parts = [df.where(F.col("batch") > newer[s]).select(kind) for s, df in facts.items()]
    kept = [df for s, df in facts.items() if newer[s] >= 0]  # all periods of the others are there already
    if S.CLIENTS in rows and kept:
        came = rows[S.CLIENTS].where(F.col("batch") > newer[S.CLIENTS]).select("client_id").dropna().distinct()
        if not came.isEmpty():
            parts += [df.select("client_id", kind).distinct().join(came, "client_id", "left_semi").select(kind) for df in kept]
    if not parts:
        return []
    found = reduce(DataFrame.unionAll, parts).distinct().select(F.col(kind).cast("string"))
    return sorted((r[0] for r in found.collect()), key=lambda p: (p is None, p))


def refresh_changed(spark: SparkSession, landing: dict[str, str], work_root: str, path: str, kind: str = "day",
                    checkpoint_root: str | None = None, salt_buckets: int = 0, max_files_per_trigger: int | None = None,
                    json_lines: bool = False, date_format: str | None = None) -> list[str | None] | None:
    """Land new files and rebuild the periods of ``path`` that they change.

    The table then holds the rows that a full rebuild gives. Returns the rebuilt periods'
    first days (None stands for rows without a date), or None when an essential
    source is still missing; its batches then wait for the next refresh. When the table's
    folder is gone, all periods are built. ``kind`` (one of ``PERIODS``) belongs to the work
    folder and the table; it cannot change later."""
    if kind not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {kind!r}")
    with released_shuffles(spark):
        land_new_files(spark, landing, work_root, checkpoint_root, max_files_per_trigger, json_lines)
        return _apply_landed(spark, list(landing), work_root, path, kind, salt_buckets, date_format)


def _apply_landed(spark: SparkSession, sources: list[str], work_root: str, path: str, kind: str, salt_buckets: int,
                  date_format: str | None) -> list[str | None] | None:
    """The part of ``refresh_changed`` behind the landing."""
    newer = {s: _applied(spark, work_root, s) for s in sources}
    batches = {s: _batches(spark, f"{work_root}/bronze/{s}") for s in sources}
    run_concurrently({(s, b): lambda s=s, b=b: _keep_clean(spark, work_root, s, b, kind, date_format)
                      for s, ids in batches.items() for b in ids if b > newer[s]})
    rows = {s: _clean(spark, work_root, s, kind) for s, ids in batches.items() if ids}
    if not essential_sources_present(rows):
        log.error("essential sources missing or empty; the final table stays as it is")
        return None
    built = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not built.getFileSystem(spark._jsc.hadoopConfiguration()).exists(built):
        newer = dict.fromkeys(newer, -1)
    periods = changed_periods(rows, newer, kind)
    if periods:
        cleaned = {s: (df if s == S.CLIENTS else df.where(_within(kind, periods)).drop(kind)).drop("batch") for s, df in rows.items()}
        final = build_final(cleaned, salt_buckets, deal=lambda df: _dealt(df.withColumn(kind, _period(kind)), [kind]))
        _spread_write(final.withColumn(kind, _period(kind)), path, [kind], "dynamic", True)
    for source, ids in batches.items():
        if ids and ids[-1] > newer[source]:
            V.set_current(spark, f"{work_root}/applied/{source}", str(ids[-1]))
    log.info("rebuilt %d periods", len(periods))
    return periods


def read_periods(spark: SparkSession, path: str, kind: str = "day", first=None, last=None) -> DataFrame:
    """The table that ``refresh_changed`` keeps; a date range (inclusive days) opens its periods' folders only."""
    df = spark.read.parquet(path)
    df = df.withColumn(kind, F.col(kind).cast("date"))
    day = F.to_date("date")
    if first is not None:
        low = F.lit(first).cast("date")
        df = df.where((F.col(kind) >= (low if kind == "day" else F.trunc(low, kind))) & (day >= low))
    if last is not None:
        high = F.lit(last).cast("date")
        df = df.where((F.col(kind) <= high) & (day <= high))
    return df.drop(kind)
