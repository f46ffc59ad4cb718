"""Refresh the final table and reports when raw files arrive (STM1, STM2).

Design (Structured Streaming, file sources):

1. *Land.* One stream of file names per raw source folder, filtered to its
   suffix (``*.csv`` / ``*.json``, or these and ``.gz``, sub-folders included). Each micro-batch reads
   its files with the batch reader (by header, required columns, malformed JSON):
   good files are written to ``<work>/bronze/<source>/batch=<id>`` with
   overwrite, so a batch replayed after a failure rewrites the same folder
   (exactly-once landing); bad ones are listed in ``<work>/quarantine``. Stream progress lives in the checkpoint folder, which must be
   on shared storage (``spark.checkpoint.dir``) so a restarted driver or a
   lost executor resumes where it stopped.
2. *Recompute.* When the trigger has drained the new files, the whole
   batch is recomputed from the landed (columnar) data and the final table
   and reports are replaced -- a new file can change any row (new revenue
   changes attribution of old touchpoints, a new client changes joined
   attributes), so a full recompute is the correct refresh.

Raw text is parsed once, at landing; recomputes read parquet.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from adtrail import schemas as S
from adtrail.plans.batch import analyze, log_quality, quality_metrics, transform_sources
from adtrail.sinks import save_final
from adtrail.sources.files import blank_frame, coerce_source, essential_sources_present
from adtrail.sources.scan import EMPTY, OK, STATUS_SCHEMA, is_missing_path, scan_source

log = logging.getLogger(__name__)

# fixed values: file suffix per source format (STM2); files may be compressed by gzip
SUFFIX = {"csv": "*.csv{,.gz}", "json": "*.json{,.gz}"}

MAX_FILES_PER_TRIGGER = 10_000  # a larger backlog is drained in several micro-batches


def source_format(source: str) -> str:
    return "json" if source == S.FACEBOOK_ADS else "csv"


# a stream of files needs the listing's schema up front
FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, source: str, folder: str,
              max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Paths of one source folder's new files as a streaming frame (STM2);
    their content is not read here."""
    return (spark.readStream.schema(FILE_LISTING).format("binaryFile")
            .option("pathGlobFilter", SUFFIX[source_format(source)]).option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(folder).select("path"))


def land_files(spark: SparkSession, source: str, folder: str, work_root: str, checkpoint: str,
               max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, json_lines: bool = False):
    """Start a stream that lands a folder's new files and stops when those
    present at start are done.

    Each micro-batch passes its files (at most ``max_files_per_trigger``)
    through the batch reader's checks (SRC7, SRC8): rows of accepted files go to
    ``bronze/<source>/batch=<id>``, the others' names and faults to
    ``quarantine/<source>/batch=<id>``. Both overwrite, so a replayed batch lands once."""
    def land(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]
        if not paths:
            return
        scan = scan_source(spark, source, paths, json_lines=json_lines)
        if scan.rows is not None:
            scan.rows.write.mode("overwrite").parquet(f"{work_root}/bronze/{source}/batch={batch_id}")
        bad = [s for s in scan.statuses if s[2] not in (OK, EMPTY)]
        if bad:
            (spark.createDataFrame(bad, STATUS_SCHEMA).coalesce(1).write.mode("overwrite")
             .parquet(f"{work_root}/quarantine/{source}/batch={batch_id}"))

    stream = new_files(spark, source, folder, max_files_per_trigger)
    return (stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .queryName(f"land_{source}").trigger(availableNow=True).start())


def read_quarantine(spark: SparkSession, work_root: str, sources=S.ALL_SOURCES) -> DataFrame:
    """Rejected files so far: ``source, file, status, missing, records, corrupt_records, batch``."""
    out = spark.createDataFrame([], f"{STATUS_SCHEMA}, batch int")
    for source in sources:
        try:
            out = out.unionByName(spark.read.parquet(f"{work_root}/quarantine/{source}"))
        except AnalysisException as err:
            if not is_missing_path(err):
                raise
    return out


def land_stream(stream: DataFrame, bronze: str, checkpoint: str, name: str | None):
    """Start a stream that lands each micro-batch idempotently as parquet
    and stops when the files present at start are processed."""
    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{bronze}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True).start()


def land_new_files(spark: SparkSession, landing: dict[str, str], work_root: str,
                   checkpoint_root: str | None = None, max_files_per_trigger: int | None = None,
                   json_lines: bool = False) -> None:
    """Land every source folder's new files into bronze parquet (step 1); bad
    files are listed in the quarantine and change nothing else."""
    # progress lies beside the rows it accounts for: another work folder starts anew
    ckpt = checkpoint_root or f"{work_root}/progress"
    queries = [land_files(spark, src, folder, work_root, f"{ckpt}/{src}",
                          max_files_per_trigger or MAX_FILES_PER_TRIGGER, json_lines)
               for src, folder in landing.items()]
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def read_landed(spark: SparkSession, work_root: str, sources=S.ALL_SOURCES,
                date_format: str | None = None) -> dict[str, DataFrame]:
    """Landed rows per source, coerced like the file readers do; a source
    with nothing landed yet is the empty marker."""
    out = {}
    for src in sources:
        try:
            df = spark.read.option("mergeSchema", True).parquet(f"{work_root}/bronze/{src}").drop("batch")
        except AnalysisException as err:
            if not is_missing_path(err):
                raise
            df = blank_frame(spark)
        out[src] = coerce_source(df, src, date_format=date_format) if df.columns else df
    return out


def refresh(spark: SparkSession, landing: dict[str, str], work_root: str, output: dict,
            reports_dir: str | None = None, checkpoint_root: str | None = None,
            salt_buckets: int = 0, max_files_per_trigger: int | None = None,
            json_lines: bool = False, date_format: str | None = None) -> dict | None:
    """Land new files, then rebuild the final table (and reports) from all
    landed data (STM1). Returns the written output config with the observed
    quality counts, or None when there is no client dimension yet."""
    land_new_files(spark, landing, work_root, checkpoint_root, max_files_per_trigger, json_lines)
    landed = read_landed(spark, work_root, list(landing), date_format)
    if not essential_sources_present(landed):
        log.error("essential sources missing or empty; the final table stays as it is")
        return None
    final = transform_sources(landed, salt_buckets=salt_buckets)
    if final is None:
        log.warning("nothing to refresh yet")
        return None
    observe, obs = quality_metrics()
    written = save_final(final, output, observe)
    if written is not None:
        written = {**written, "quality": obs.get}
        log_quality(written["quality"])
    if reports_dir:
        analyze(spark, written, reports_dir)
    return written
