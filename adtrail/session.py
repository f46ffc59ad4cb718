"""Session construction and the shared checkpoint folder.

Cluster settings win: a default below is applied only when the key is not
already set on the session (e.g. by spark-submit or spark-defaults).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults sized for large inputs; AQE coalesces the many initial shuffle
# partitions down to ~128 MB each at run time (honouring that size rather
# than maximising the partition count) and splits skewed ones.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

# Local runs have small inputs and idle cores: keep post-shuffle stages wide.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "adtrail",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the scale defaults.

    ``master`` is only for local runs and tests; on a cluster leave it None
    and let the launcher decide.
    """
    builder = SparkSession.builder.appName(app_name)
    defaults = dict(SCALE_DEFAULTS)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            defaults.update(LOCAL_DEFAULTS)
    given = conf or {}
    # the caller's settings, and those that only count when the JVM starts
    for k, v in {**{k: v for k, v in defaults.items() if not k.startswith("spark.sql.")}, **given}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in defaults.items():
        if k.startswith("spark.sql.") and k not in given and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and staged tables.

    Read from ``spark.checkpoint.dir``. Only a local session (tests, a
    laptop) may fall back to a private temporary folder; on a cluster an
    unset value is an error, because a machine-local folder would not
    survive the loss of that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        root = tempfile.mkdtemp(prefix="adtrail-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-path of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, *parts) if "://" not in root else "/".join([root.rstrip("/"), *parts])


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint root that goes when the application ends."""
    path = checkpoint_path(spark, "scratch", f"{tag}-{uuid.uuid4().hex}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go as each query ends.

    Otherwise Spark keeps them until the driver collects garbage, which a driver
    with free memory may not do before the executors' disks are full. Not to be
    entered from several threads at once: the setting is the session's."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
