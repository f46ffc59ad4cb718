"""Stack cleaned sources into the 18-column fact table (SET1, PRJ5,
PRJ8, NUL1-NUL3).

Every source is first projected onto the fixed fact schema (missing columns
become typed NULLs), then the projections are combined with UNION ALL. That
is a narrow operation: no shuffle, each input partition becomes an output
partition.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.functions.parsing import quote
from adtrail.operators.cleaning import is_blank

log = logging.getLogger(__name__)


def empty_frame(spark: SparkSession, schema=S.FACT_SCHEMA) -> DataFrame:
    """Zero rows with a full typed schema (PRJ8)."""
    return spark.createDataFrame([], schema)


def _sql_default(name: str, expr: str, dtype) -> str:
    if name in S.FACT_ZERO_COLUMNS:
        return f"COALESCE({expr}, CAST(0 AS {dtype.simpleString()}))"
    if name in S.FACT_RATE_COLUMNS:
        return f"COALESCE({expr}, CAST(0.0 AS DOUBLE))"
    if name in S.FACT_TEXT_COLUMNS:
        return f"COALESCE({expr}, '{S.UNKNOWN}')"
    return expr


def _aligned_exprs(df: DataFrame, schema) -> list[tuple[str, str, T.DataType]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        if f.name not in types:
            e = f"CAST(NULL AS {t})"
        elif types[f.name] == f.dataType:
            e = quote(f.name)
        else:
            e = f"TRY_CAST({quote(f.name)} AS {t})"
        out.append((f.name, e, f.dataType))
    return out


def align_to_schema(df: DataFrame, schema=S.FACT_SCHEMA) -> DataFrame:
    """Select exactly the schema's columns in its order; absent -> NULL."""
    return df.selectExpr(*[f"{e} AS {quote(n)}" for n, e, _ in _aligned_exprs(df, schema)])


def fill_fact_defaults(df: DataFrame) -> DataFrame:
    """Numbers NULL -> 0, rates NULL -> 0.0, descriptive text NULL ->
    'Unknown'. ``client_id``, ``date`` and ``platform`` stay as they are."""
    return df.selectExpr(*[f"{_sql_default(f.name, quote(f.name), f.dataType)} AS {quote(f.name)}"
                           for f in df.schema.fields])


def aligned_fact_branch(df: DataFrame) -> DataFrame:
    """One source on the fact schema with its defaults filled, in a single
    projection (the defaults commute with UNION ALL). Written as SQL
    expressions: one call to the JVM instead of one per expression node."""
    return df.selectExpr(*[f"{_sql_default(n, e, t)} AS {quote(n)}"
                           for n, e, t in _aligned_exprs(df, S.FACT_SCHEMA)])


def fact_branches(cleaned: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every cleaned source except ``clients`` (so revenue rows are facts
    too) on the fixed fact schema, keyed by its platform tag; empty
    sources are left out."""
    return {name: aligned_fact_branch(df) for name, df in cleaned.items()
            if name != S.CLIENTS and df is not None and not is_blank(df)}


def union_branches(frames: list[DataFrame], spark: SparkSession | None = None,
                   schema=S.FACT_SCHEMA) -> DataFrame:
    """UNION ALL; an empty typed frame when there is nothing to stack."""
    if not frames:
        log.warning("no fact sources to combine")
        return empty_frame(spark or SparkSession.getActiveSession(), schema)
    return reduce(DataFrame.unionAll, frames)


def combine_facts(cleaned: dict[str, DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """UNION ALL of every cleaned source except ``clients`` (so revenue rows
    are facts too), on the fixed schema, with defaults filled (SET1).

    Empty sources contribute no rows; with no usable source at all the
    result is an empty typed frame.
    """
    return union_branches(list(fact_branches(cleaned).values()), spark)
