"""Per-source cleaning: canonical names (PRJ1/PRJ2) and types (PRJ3).

Each function is ``DataFrame -> DataFrame``: one ``select``, no action, no
shuffle. Whatever the raw type of a column (text from CSV/JSON, or already
typed from parquet), the output type is fixed. ``clean_source`` composes
renaming and typing into a single projection.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions.parsing import (count_sql, duration_sql, key_sql, number_sql, quote,
                                       timestamp_sql)

log = logging.getLogger(__name__)

Item = tuple[str, str, T.DataType]  # (output name, SQL text, input type)


def is_blank(df: DataFrame | None) -> bool:
    """True for the 'empty file' marker: a frame with no columns."""
    return df is not None and len(df.columns) == 0


def _standardized_items(df: DataFrame, platform: str) -> list[Item]:
    types = {f.name: f.dataType for f in df.schema.fields}
    mapping = S.COLUMN_MAPS.get(platform)
    tag = ("platform", f"'{platform}'", T.StringType())
    if mapping is None:
        log.warning("no column map for %s; keeping all columns", platform)
        items = [(n, quote(n), types[n]) for n in df.columns if n != "platform"]
        if "platform" in types:
            pos = df.columns.index("platform")
            return items[:pos] + [tag] + items[pos:]
        return items + [tag]
    items = [(canon, quote(raw), types[raw]) for raw, canon in mapping.items() if raw in types]
    return items + [tag]


def _typed(items: list[Item]) -> list[str]:
    out = []
    duration = None
    for name, x, t in items:
        if name == S.DURATION_TEXT_COLUMN:
            duration = x
            continue
        if name in S.TEXT_KEY_COLUMNS:
            x = key_sql(x)
        elif name in S.DATE_COLUMNS:
            x = timestamp_sql(x, t)
        elif name in S.COUNT_COLUMNS:
            x = count_sql(x, t)
        elif name in S.AMOUNT_COLUMNS:
            x = number_sql(x, t)
        out.append(f"{x} AS {quote(name)}")
    if duration is not None:
        out.append(f"{duration_sql(duration)} AS {quote(S.DURATION_SECONDS_COLUMN)}")
    return out


def standardize_columns(df: DataFrame, platform: str) -> DataFrame:
    """Rename raw columns to canonical names, keep only mapped ones (in map
    order, absent ones skipped) and tag the rows with ``platform``.

    Sources without a map (e.g. clients) keep every column and get the tag.
    Renames happen in one ``select``, so facebook's own ``platform`` column
    becomes ``platform_detail`` before the tag is added.
    """
    return df.selectExpr(*[f"{x} AS {quote(n)}" for n, x, _ in _standardized_items(df, platform)])


def enforce_types(df: DataFrame) -> DataFrame:
    """Coerce the known canonical columns that are present; leave the rest.

    dates -> timestamp_ntz (bad -> NULL); counts -> bigint (bad/NULL -> 0);
    amounts and rates -> double (bad -> NULL); ``client_id`` -> text;
    ``avg_session_duration_str`` is replaced by whole seconds appended last.
    """
    return df.selectExpr(*_typed([(f.name, quote(f.name), f.dataType) for f in df.schema.fields]))


def clean_source(df: DataFrame, platform: str) -> DataFrame:
    """PRJ1 then PRJ3 for one source, as one projection; an empty-file
    marker passes through."""
    if is_blank(df):
        log.warning("source %s is empty", platform)
        return df
    return df.selectExpr(*_typed(_standardized_items(df, platform)))


def clean_sources(sources: dict[str, DataFrame | None]) -> dict[str, DataFrame]:
    """Clean every source; ``None`` (invalid source) is dropped (PRJ4)."""
    cleaned = {}
    for platform, df in sources.items():
        if df is None:
            log.error("source %s is invalid (None); dropped", platform)
            continue
        cleaned[platform] = clean_source(df, platform)
    return cleaned
