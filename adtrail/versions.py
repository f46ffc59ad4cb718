"""Versioned folders: a reader sees the whole old data or the whole new.

A dataset's root folder holds one sub-folder per version and a small pointer
file that names the current one. A write goes to a new version; only when its
job has committed is the pointer replaced, in one rename. A job that dies half-way
leaves the pointer, and so the data, as they were. The version before the current
stays for readers that have begun; earlier ones, and what failed writes left, are
deleted by the next write. One writer at a time per root.

Beside the data, a version holds its file index: each data file with its least
and largest date, so a date filter opens the files it needs and no others.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.sources.scan import as_glob

POINTER = "_current"  # readers of a folder skip names that begin with an underscore
DATA, FILES, SCHEMA = "data", "files", "_schema.json"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def new_version() -> str:
    """Names sort by time."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see; None when ``root`` is no versioned folder."""
    path, fs = _fs(spark, f"{root}/{POINTER}")
    if not fs.exists(path):
        return None
    return _read_line(spark, path, fs)


def _read_line(spark: SparkSession, path, fs) -> str:
    stream = fs.open(path)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def _write_line(fs, path, text: str) -> None:
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_schema(spark: SparkSession, root: str, version: str, schema: T.StructType) -> None:
    """Keep a version's columns beside its data: a dataset without rows has no file that names them."""
    path, fs = _fs(spark, f"{root}/{version}/{SCHEMA}")
    _write_line(fs, path, schema.json())


def read_version(spark: SparkSession, root: str, version: str, files: Sequence[str] = ()) -> DataFrame:
    """A version's data, or some of its files."""
    path, fs = _fs(spark, f"{root}/{version}/{SCHEMA}")
    schema = T.StructType.fromJson(json.loads(_read_line(spark, path, fs)))
    data = f"{root}/{version}/{DATA}"
    df = spark.read.schema(schema).option("basePath", data).parquet(*(as_glob(files) or [data]))
    return df.select(*[f"`{c}`" for c in schema.names])


def set_current(spark: SparkSession, root: str, version: str) -> None:
    """Replace the pointer by one rename over the old one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path, fs = _fs(spark, f"{root}/{POINTER}.{version}")
    _write_line(fs, path, version)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    qualified = fs.makeQualified(path)
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(qualified, target, options)


def versions(spark: SparkSession, root: str) -> list[str]:
    path, fs = _fs(spark, root)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith("v"))


def delete_others(spark: SparkSession, root: str, keep: Sequence[str | None]) -> None:
    for name in versions(spark, root):
        if name not in keep:
            path, fs = _fs(spark, f"{root}/{name}")
            fs.delete(path, True)


def index_files(spark: SparkSession, root: str, version: str) -> None:
    """Write the file index of a version: ``file`` (below the data folder, as
    a URI part), ``first_date``, ``last_date``, ``rows``. Reads the date column only."""
    below = F.regexp_extract(F.col("_metadata.file_path"), f"/{version}/{DATA}/(.*)$", 1)
    per_file = read_version(spark, root, version).groupBy(below.alias("file")).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("rows"))
    per_file.write.mode("overwrite").parquet(f"{root}/{version}/{FILES}")


def read_current(spark: SparkSession, root: str, first=None, last=None) -> DataFrame | None:
    """The current version; with dates, only its files that hold a date of
    that (inclusive) range. None when ``root`` is no versioned folder."""
    version = current_version(spark, root)
    if version is None:
        return None
    whole = read_version(spark, root, version)
    index, fs = _fs(spark, f"{root}/{version}/{FILES}")
    if (first is None and last is None) or not fs.exists(index):
        return whole
    held = spark.read.parquet(f"{root}/{version}/{FILES}")
    if first is not None:
        held = held.where(F.col("last_date") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        held = held.where(F.col("first_date") <= F.lit(last).cast("timestamp_ntz"))
    files = [f"{root}/{version}/{DATA}/{unquote(r['file'])}" for r in held.select("file").collect()]
    return read_version(spark, root, version, files) if files else whole.limit(0)
