"""Reading the final analytics table back (SRC12, SRC13) and the
parse-quality probe (SRC9)."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail import versions as V
from adtrail.functions.parsing import to_timestamp_ntz
from adtrail.sources.scan import is_missing_path

log = logging.getLogger(__name__)


def load_analytics(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                   table: str | None = S.FINAL_TABLE, date_range: tuple | None = None) -> DataFrame | None:
    """Final table from a parquet folder (versioned or plain) or a catalog
    table; unknown format or missing data -> None. ``date`` is parsed and
    NULL-date rows dropped.

    ``date_range`` (one date, or first and last) keeps these days (FLT3, FLT4);
    a versioned folder then opens only the files that hold them.
    """
    first, last = (date_range[0], date_range[-1]) if date_range else (None, None)
    try:
        if fmt == "parquet":
            df = V.read_current(spark, path, first, last)
            if df is None:
                df = spark.read.parquet(path)
        elif fmt == "table":
            if not spark.catalog.tableExists(table):
                log.error("table %s not found", table)
                return None
            df = spark.table(table)
        else:
            log.error("unsupported format %s", fmt)
            return None
    except AnalysisException as err:
        if is_missing_path(err):
            log.error("analytics data not found at %s", path)
            return None
        raise
    if "date" in df.columns:
        df = (df.withColumn("date", to_timestamp_ntz("date", df.schema["date"].dataType))
              .where(F.col("date").isNotNull()))
        if date_range:
            df = df.where(F.col("date").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))
    return df


def parse_quality(sources: dict[str, DataFrame]) -> DataFrame | None:
    """Per source and coerced column: how many values are NULL after
    coercion (SRC9). One aggregate pass per source (``count_if`` for all
    columns at once), unpivoted to (source, column, null_count)."""
    parts = []
    for source, df in sources.items():
        if df is None or not df.columns:
            continue
        cols = [c for c in S.INGEST_DATE_COLUMNS.get(source, []) + S.INGEST_NUMERIC_COLUMNS.get(source, [])
                if c in df.columns]
        if not cols:
            continue
        counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
        long = counts.unpivot([], cols, "column", "null_count")
        parts.append(long.select(F.lit(source).alias("source"), "column", "null_count"))
    if not parts:
        return None
    return reduce(DataFrame.unionAll, parts)
