"""Column expressions that coerce raw text and numbers.

Every rule is written once, as Spark SQL expression text built from a
column name (``*_sql`` functions). The Column helpers wrap that text with
``F.expr``; the cleaning steps put many of them into one ``selectExpr``, so
a wide projection costs one call into the JVM instead of one per
expression node. All of them are built-in expressions (``try_cast``,
``try_to_timestamp``, ``split``, ``try_multiply``): they stay inside
whole-stage codegen, and bad input -- including values that would
overflow -- becomes NULL or a default instead of failing the job under
ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.schemas import NA_TOKENS

# fixed values: text date layouts accepted besides ISO-8601 (tried in order)
EXTRA_DATE_FORMATS = ["yyyy/MM/dd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss"]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DATETIME = (T.TimestampNTZType, T.TimestampType, T.DateType)


NUMBER_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --- SQL text builders (x is SQL expression text) ----------------------------

def na_to_null_sql(x: str) -> str:
    tokens = ", ".join(_lit(t) for t in NA_TOKENS)
    return f"CASE WHEN trim({x}) IN ({tokens}) THEN CAST(NULL AS STRING) ELSE {x} END"


def number_sql(x: str, dtype: T.DataType | None = None) -> str:
    if isinstance(dtype, _INTEGRAL):
        return f"CAST({x} AS DOUBLE)"
    d = f"TRY_CAST({x} AS DOUBLE)"
    if dtype is None or isinstance(dtype, T.StringType):
        # the cast also takes Java's suffixes and hexadecimal floats ('10d', '0x10p1')
        d = f"CASE WHEN trim({x}) RLIKE {_lit(NUMBER_SHAPE)} THEN {d} END"
    # Spark orders NaN above +inf, so the test is false for NaN, +-inf and NULL.
    return f"CASE WHEN abs({d}) < double('Infinity') THEN {d} END"


def count_sql(x: str, dtype: T.DataType | None = None) -> str:
    if isinstance(dtype, _INTEGRAL):
        return f"COALESCE(CAST({x} AS BIGINT), CAST(0 AS BIGINT))"
    return f"COALESCE(TRY_CAST({number_sql(x, dtype)} AS BIGINT), CAST(0 AS BIGINT))"


def timestamp_sql(x: str, dtype: T.DataType | None = None, fmt: str | None = None) -> str:
    """Zone-free timestamp; with ``fmt`` only that layout is accepted (a
    source whose date layout is known), else ISO-8601 then the extra
    layouts in order."""
    if isinstance(dtype, _DATETIME):
        return f"CAST({x} AS TIMESTAMP_NTZ)"
    if isinstance(dtype, _NUMERIC):
        return "CAST(NULL AS TIMESTAMP_NTZ)"
    s = f"CAST({x} AS STRING)"
    if fmt:
        return f"CAST(try_to_timestamp({s}, {_lit(fmt)}) AS TIMESTAMP_NTZ)"
    parts = [f"TRY_CAST({s} AS TIMESTAMP_NTZ)"]
    parts += [f"CAST(try_to_timestamp({s}, {_lit(layout)}) AS TIMESTAMP_NTZ)" for layout in EXTRA_DATE_FORMATS]
    return f"COALESCE({', '.join(parts)})"


def key_sql(x: str) -> str:
    return f"CAST({x} AS STRING)"


def duration_sql(x: str) -> str:
    parts = f"split(CAST({x} AS STRING), ':', -1)"

    def part(i: int) -> str:
        return f"TRY_CAST(get({parts}, {i}) AS BIGINT)"

    hms = (f"try_add(try_add(try_multiply({part(0)}, 3600), try_multiply({part(1)}, 60)), {part(2)})")
    ms = f"try_add(try_multiply({part(0)}, 60), {part(1)})"
    return (f"COALESCE(CASE size({parts}) WHEN 3 THEN {hms} WHEN 2 THEN {ms} END, "
            f"CAST(0 AS BIGINT))")


# --- Column helpers (c is a column name) -------------------------------------

def na_to_null(c: str) -> Column:
    """Text tokens that CSV exports use for 'missing' become NULL."""
    return F.expr(na_to_null_sql(quote(c)))


def to_number(c: str, dtype: T.DataType | None = None) -> Column:
    """Numeric parse, bad -> NULL. NaN and +-infinity also become NULL so
    aggregates skip them (CST1)."""
    return F.expr(number_sql(quote(c), dtype))


def to_count(c: str, dtype: T.DataType | None = None) -> Column:
    """Count columns: NULL, unparseable or out of range -> 0, fraction
    truncated (CST2)."""
    return F.expr(count_sql(quote(c), dtype))


def to_timestamp_ntz(c: str, dtype: T.DataType | None = None, fmt: str | None = None) -> Column:
    """Zone-free timestamp parse, bad -> NULL (DT1); ``fmt`` fixes the
    layout when a source's date format is known."""
    return F.expr(timestamp_sql(quote(c), dtype, fmt))


def to_key(c: str) -> Column:
    """Join keys are text (STR2)."""
    return F.expr(key_sql(quote(c)))


def duration_seconds(c: str) -> Column:
    """``H:M:S`` or ``M:S`` text -> whole seconds; any other shape, a part
    that is not an integer, an overflowing value, or NULL -> 0 (STR1)."""
    return F.expr(duration_sql(quote(c)))


def strip_prefix(c: str, prefix: str) -> Column:
    """Remove every occurrence of ``prefix`` text from an id (STR3)."""
    return F.replace(F.col(c).cast("string"), F.lit(prefix), F.lit(""))
