"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.session import checkpoint_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Python tasks cut their input into slices of about this many bytes of text,
# so a worker's memory does not depend on the row count of an Arrow batch.
SLICE_BYTES = 1 << 20

# Bytes of an Arrow batch sent to a Python worker, unless the session says otherwise: Spark's own
# 64 MB, held on both sides and twice while it grows, is much of a small executor's memory.
BATCH_BYTES = "8m"

# Tables of a few numbers or a word a row are broadcast up to this many rows (a
# few dozen MB at most); larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver runs elsewhere
    than in the repository folder (on a cluster: ``--py-files``)."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (PACKAGE_ROOT, path) if p)


def map_batches(df: DataFrame, func: Callable, schema: str, **params) -> DataFrame:
    """``mapInArrow`` with keyword parameters bound to a module-level function
    ``func(batches, **params)``."""
    ship(df.sparkSession)
    if df.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(partial(func, **params), schema)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint root, removed when the
    application's file system client closes."""
    path = checkpoint_path(spark, "llm", f"{tag}-{uuid.uuid4().hex}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).deleteOnExit(p)
    return path


def materialize(df: DataFrame, tag: str, group_rows: int | None = None) -> DataFrame:
    """Write a table that several later steps read to the shared folder and
    read it back. It cuts lineage and survives lost executors. Tables whose
    rows are megabytes each give the rows of a row group: the writer looks at
    its size only every hundred rows, and the reader holds a row group's rows at once."""
    path = scratch_path(df.sparkSession, tag)
    writer = df.write.option("compression", "zstd")
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast when the counted rows are few; else the planner's join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so further
    columns of any name cannot clash. A null text is the empty text."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit``; one
    item larger than that is a range of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
