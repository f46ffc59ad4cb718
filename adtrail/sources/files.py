"""Raw source readers (SRC1-SRC11).

``adtrail.sources.scan`` accepts or rejects each file of a source and reads
the accepted ones as text; here missing-value tokens become NULL and the
ingest-time coercions (dates, numerics; bad -> NULL) are applied as column
expressions. Outcomes follow one convention:

* ``None``            -- the source is invalid (missing path, no file with the
                         required columns, malformed JSON);
* a frame with no columns -- the files exist but all are empty;
* otherwise           -- a lazy frame of the accepted files' rows.

CSV is read splittable by default (``multiline=False``), so a large export
is scanned by many tasks; set ``multiline=True`` only for files with
quoted line breaks, which forces one task per file. A top-level JSON array
splits when each of its records is a line, else it is likewise one task per
file; JSON Lines (``json_lines=True``) splits.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions.parsing import na_to_null_sql, number_sql, quote, timestamp_sql
from adtrail.sources.scan import SourceScan, list_files, scan_csv, scan_json

log = logging.getLogger(__name__)


def blank_frame(spark: SparkSession) -> DataFrame:
    """The 'empty file' marker: zero rows, zero columns."""
    return spark.createDataFrame([], T.StructType([]))


def coerce_source(df: DataFrame, source: str, text_tokens: bool = True,
                  date_format: str | None = None) -> DataFrame:
    """Text cleanup plus the reader-level coercions of one source.

    ``text_tokens=False`` skips the missing-value-token check, for inputs
    that are typed columns rather than text exports."""
    dates = set(S.INGEST_DATE_COLUMNS.get(source, []))
    nums = set(S.INGEST_NUMERIC_COLUMNS.get(source, []))
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for name in df.columns:
        x = quote(name)
        if text_tokens and isinstance(types[name], T.StringType):
            x = na_to_null_sql(x)
        if name in dates:
            x = timestamp_sql(x, types[name], date_format)
        elif name in nums:
            x = number_sql(x, types[name])
        exprs.append(f"{x} AS {quote(name)}")
    return df.selectExpr(*exprs)


def read_csv_source(spark: SparkSession, path: str, source: str, multiline: bool = False,
                    date_format: str | None = None) -> DataFrame | None:
    """CSV exports with a header line each (SRC1, SRC2, SRC4, SRC5, SRC6). Columns
    go by name, whatever their order in a file."""
    return _coerced(spark, scan_csv(spark, source, path, multiline=multiline), path, date_format)


def read_json_source(spark: SparkSession, path: str, source: str = S.FACEBOOK_ADS, json_lines: bool = False,
                     date_format: str | None = None, check_files: bool = True) -> DataFrame | None:
    """JSON exports: a top-level array of objects a file, or JSON Lines (SRC3).

    A file without records has no columns, so it lacks the required ones: with
    no other file the source is invalid (SRC8)."""
    scan = scan_json(spark, source, path, json_lines=json_lines, check_files=check_files)
    return _coerced(spark, scan, path, date_format, empty_is_valid=False)


def _coerced(spark: SparkSession, scan: SourceScan, path: str, date_format: str | None,
             empty_is_valid: bool = True) -> DataFrame | None:
    if not scan.found:
        log.error("%s not found at %s", scan.source, path)
        return None
    if scan.rows is None:
        if empty_is_valid and scan.only_empty():
            log.warning("%s is empty at %s", scan.source, path)
            return blank_frame(spark)
        log.error("%s has no valid file at %s", scan.source, path)
        return None
    return coerce_source(scan.rows, scan.source, date_format=date_format)


def read_source(spark: SparkSession, source: str, path: str, **options) -> DataFrame | None:
    """Dispatch by source name: facebook is JSON, the rest CSV."""
    if source == S.FACEBOOK_ADS:
        return read_json_source(spark, path, source, **options)
    return read_csv_source(spark, path, source, **options)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, via the session's file listing."""
    return list_files(spark, path) is not None


def ingest_all(spark: SparkSession, paths: dict[str, str], **options) -> dict[str, DataFrame]:
    """Read every configured source (SRC10). A missing file gives the empty
    marker; an invalid source (reader returned None) is left out."""
    data = {}
    for source, path in paths.items():
        if not path_exists(spark, path):
            log.warning("raw file for %s not found at %s; treated as empty", source, path)
            data[source] = blank_frame(spark)
            continue
        df = read_source(spark, source, path, **options.get(source, {}))
        if df is None:
            log.error("ingestion of %s returned None; dropped", source)
            continue
        data[source] = df
    return data


def essential_sources_present(sources: dict[str, DataFrame | None],
                              essential=S.ESSENTIAL_SOURCES) -> bool:
    """Every essential source is present and has at least one row (SRC11).

    ``isEmpty`` reads at most one row per source scan.
    """
    for key in essential:
        df = sources.get(key)
        if df is None or not df.columns or df.isEmpty():
            log.error("essential source %s is missing or empty", key)
            return False
    return True
