"""Writers (SNK1-SNK5).

All writes go through Spark's commit protocol: a task's output becomes
visible only when the job commits, so a lost executor's half-written files
are discarded and its tasks rerun. Errors are raised, never swallowed.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail import versions as V
from adtrail.operators.metrics import with_metrics_of
from adtrail.session import released_shuffles

log = logging.getLogger(__name__)


def _layout(df: DataFrame, partition_by: Sequence[str], sort_within: Sequence[str]):
    cols = set(df.columns)
    parts = [c for c in partition_by if c in cols]
    order = [c for c in sort_within if c in cols and c not in parts]
    if order:
        # No shuffle: each task sorts its own rows so parquet row groups get
        # tight min/max ranges on these columns (date filters skip groups).
        # Folder columns come first: the writer sorts by them, and would
        # otherwise undo the order within a folder.
        order = parts + order
        df = df.sortWithinPartitions(*order)
    return df, parts


def replace_table(df: DataFrame, table: str = S.FINAL_TABLE,
                  partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = ("platform", "date")) -> None:
    """Replace a catalog table with ``df`` (SNK1). A zero-row frame still
    creates the table with all its columns.

    Unpartitioned (the default), the data is written to a folder of its own
    under ``<warehouse>/<table>__versions`` and, once that job has committed, the
    table's location is changed in the catalog: one metadata update, no folder is
    renamed and the table never disappears. A job that fails leaves the table as
    it was. The folder before stays for readers that have begun; older ones go.
    Only when columns are removed or change their type is the table made anew
    (columns that are added are added in the catalog first).
    Rows are clustered by (platform, date) inside each task, so row groups are
    almost always single-platform and narrow in time: platform and date
    predicates skip row groups without folder partitioning. With ``partition_by``
    the table is overwritten in place.
    """
    spark = df.sparkSession
    df, parts = _layout(df, partition_by, sort_within)
    if parts:
        df.write.mode("overwrite").format("parquet").partitionBy(*parts).saveAsTable(table)
        log.info("replaced table %s in place", table)
        return
    root = table_root(spark, table)
    version = V.new_version()
    location = f"{root}/{version}"
    df.write.parquet(location)
    before = None
    if spark.catalog.tableExists(table):
        before = _location(spark, table).rstrip("/").rsplit("/", 1)[-1]
        if not _same_columns(spark, table, df):
            spark.sql(f"DROP TABLE {table}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        spark.catalog.createTable(table, path=location, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(table)
    V.delete_others(spark, root, (version, before))
    log.info("replaced table %s", table)


def table_root(spark: SparkSession, table: str) -> str:
    """Where the versions of a replaced table lie."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}__versions"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0] if rows else ""


def _same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    """Whether the table's columns fit ``df``; new columns are added to it."""
    old = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
    new = [(f.name, f.dataType) for f in df.schema.fields]
    if new[:len(old)] != old:
        return False
    if len(new) > len(old):
        added = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in new[len(old):])
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    return True


# Equality filters on these columns (the client selector) skip row groups
# through parquet bloom filters.
BLOOM_COLUMNS = ("client_id",)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("platform",),
                  sort_within: Sequence[str] = ("date",),
                  bloom_columns: Sequence[str] = BLOOM_COLUMNS) -> None:
    """Overwrite a parquet folder (SNK2); the folder is created as needed.

    Partitioning by ``platform`` lets platform filters read only their
    folders; the cardinality is a handful of values, so it never explodes
    into many small files. Rows are sorted by ``date`` inside each task
    (tight row-group ranges for date filters) and ``client_id`` gets a
    bloom filter (client equality filters skip row groups).
    """
    df, parts = _layout(df, partition_by, sort_within)
    w = df.write.mode("overwrite")
    for c in bloom_columns:
        if c in df.columns:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    log.info("wrote parquet to %s", path)


def publish_parquet(df: DataFrame, root: str, partition_by: Sequence[str] = ("platform",),
                    bloom_columns: Sequence[str] = BLOOM_COLUMNS, files: int | None = None,
                    observe: Callable[[DataFrame], DataFrame] | None = None, with_metrics: bool = False) -> str:
    """Write a parquet dataset as a new version of ``root`` and make it the
    current one (SNK2, see ``adtrail.versions``); returns the version's name.

    Rows are range partitioned by the folder columns and the date, so each
    file holds a short span of dates and a date filter opens few files; a
    hash of the row is the last key, so a date or platform that holds much of the data
    is spread over several files. ``files`` sets the number of ranges
    (default: the session's shuffle partitions, coalesced by AQE).

    Range partitioning samples the rows, so the last stage of their plan runs twice;
    ``observe`` (which adds metrics to a frame) is applied behind it, where each row passes once.
    ``with_metrics`` says that the per-row metrics of ``df`` are those of ``add_key_metrics``: they
    follow from the row, so they are not shuffled but added behind the ranges."""
    spark, columns = df.sparkSession, df.columns
    keys = [c for c in (*partition_by, "date") if c in df.columns]
    if "date" in columns:
        df = df.drop(*S.METRIC_COLUMNS) if with_metrics else df
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1024))
        ranges = [*keys, spread]
        df = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
        df = with_metrics_of(df, columns) if with_metrics else df
    df = observe(df) if observe else df
    version = V.new_version()
    before = V.current_version(spark, root)
    write_parquet(df, f"{root}/{version}/{V.DATA}", partition_by, ("date",), bloom_columns)
    V.put_schema(spark, root, version, df.schema)
    if "date" in df.columns:
        V.index_files(spark, root, version)
    V.set_current(spark, root, version)
    V.delete_others(spark, root, (version, before))
    return version


def write_report_csv(df: DataFrame, path: str, order_by: Sequence[str] = (),
                     single_file: bool = False) -> None:
    """A report as headed CSV (SNK3).

    By default the report is range-partitioned by its keys and written as
    ordered part files, so a big report never funnels through one task.
    ``single_file=True`` (one part file) is for reports known to be small.
    """
    if order_by:
        df = df.orderBy(*order_by)
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)
    log.info("wrote report %s", path)


def append_batch(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Append a new batch to an existing raw source (SNK5, SET2)."""
    w = df.write.mode("append").format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def save_final(df: DataFrame, output: dict, observe: Callable[[DataFrame], DataFrame] | None = None,
               with_metrics: bool = False) -> dict | None:
    """Write the final table as configured (SNK4).

    ``output`` maps a format (``parquet`` or ``table``) to a dict with a
    ``save`` flag plus ``path`` / ``table``. The plan of ``df`` runs once: each
    further format is written from the first one as committed; the shuffle files of a
    write go when it ends. ``observe`` adds
    metrics to the first write; ``with_metrics``: see ``publish_parquet``. Returns the first config that was written, or
    None when nothing was saved.
    """
    written = None
    for fmt, cfg in output.items():
        if not cfg.get("save"):
            continue
        if fmt == "parquet":
            with released_shuffles(df.sparkSession):
                publish_parquet(df, cfg["path"], observe=observe, with_metrics=with_metrics and written is None)
        elif fmt == "table":
            # read back, rows come file by file, and each file is of one platform and in date order
            order = ("platform", "date") if written is None or written["format"] != "parquet" else ()
            with released_shuffles(df.sparkSession):
                replace_table(observe(df) if observe else df, cfg.get("table", S.FINAL_TABLE), sort_within=order)
        else:
            raise ValueError(f"unknown output format {fmt}")
        if written is None:
            written, observe = {"format": fmt, **cfg}, None
            columns = df.columns
            done = V.read_current(df.sparkSession, cfg["path"]) if fmt == "parquet" else \
                df.sparkSession.table(cfg.get("table", S.FINAL_TABLE))
            df = done.select(*[f"`{c}`" for c in columns])
    return written
