"""Derived per-row metrics (MTH1-MTH5, NUL4, NUL5) and global means
(AG14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions import metrics as M
from adtrail.functions.parsing import to_number

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _ensured_inputs(df: DataFrame) -> dict:
    types = {f.name: f.dataType for f in df.schema.fields}
    ensured = {}
    for name in S.METRIC_INPUT_COLUMNS:
        zero = F.lit(0.0) if name == "spend_usd" else F.lit(0).cast("bigint")
        if name not in types:
            ensured[name] = zero
        elif isinstance(types[name], _NUMERIC):
            ensured[name] = F.coalesce(F.col(name), zero.cast(types[name]))
        else:
            ensured[name] = F.coalesce(to_number(name), F.lit(0.0))
    return ensured


def ensure_metric_inputs(df: DataFrame) -> DataFrame:
    """The five metric inputs exist, are numeric and non-NULL (NUL4).

    Missing ones are appended as 0; text is parsed (bad -> 0).
    """
    return df.withColumns(_ensured_inputs(df))


def ensure_rate_columns(df: DataFrame) -> DataFrame:
    """open/click/bounce rate exist (0.0 when absent); NULLs kept (NUL5)."""
    missing = {r: F.lit(0.0) for r in S.FACT_RATE_COLUMNS if r not in df.columns}
    return df.withColumns(missing) if missing else df


def add_key_metrics(df: DataFrame) -> DataFrame:
    """ctr (%), cpc_usd, cpm_usd (per mille) and total_interactions, in
    that order (MTH5). One projection; stays inside codegen.

    Columns keep their place when they already exist; new ones are
    appended: missing inputs, the three ratios, missing rate columns,
    total_interactions.
    """
    x = _ensured_inputs(df)
    new = dict(x)
    new["ctr"] = M.ctr(x["clicks"], x["impressions"])
    new["cpc_usd"] = M.cpc(x["spend_usd"], x["clicks"])
    new["cpm_usd"] = M.cpm(x["spend_usd"], x["impressions"])
    for r in S.FACT_RATE_COLUMNS:
        if r not in df.columns:
            new[r] = F.lit(0.0)
    new["total_interactions"] = M.total_interactions(x["clicks"], x["emails_sent"], x["sessions"])
    return df.withColumns(new)


def with_metrics_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` without metrics, as rows travel, with its metrics again: ``columns`` in their order."""
    return add_key_metrics(df).select(*[F.col(f"`{c}`") for c in columns])


def summarize_metrics(df: DataFrame) -> DataFrame:
    """One row of seven means; NULL/NaN skipped, NULL on empty input.

    A single global aggregate: each task emits one partial (sum, count) per
    column, so only a handful of rows reach the final reduction.
    """
    missing = [c for c in S.SUMMARY_COLUMNS.values() if c not in df.columns]
    if missing:
        raise ValueError(f"summarize_metrics needs columns {missing}")
    return df.agg(*[M.nan_skipping_mean(src).alias(out) for out, src in S.SUMMARY_COLUMNS.items()])
