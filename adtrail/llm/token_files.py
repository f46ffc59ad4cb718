"""Token-id files (operator 6).

Token ids are written as a Parquet list column, one row per document in
ascending id order, range partitioned so that file k holds smaller ids than
file k + 1. The list values are dictionary encoded (16 bits an id for a 50k
vocabulary), the sorted and running columns use the delta encodings of data
page version 2, and row groups and pages are bounded, so the page index lets
a reader fetch the tokens of a few documents, or the metadata alone, without
the rest.

Defined cases: a null text is the empty text (the end id alone is stored);
null ids sort first; rows with the same id are ordered by their text; an empty
table gives an empty dataset; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm import tokens

END_ID = 0
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 256

FILE_SCHEMA = "doc_id long, file int, file_start long, n_tokens long, ids array<int>"


def encode_sorted(batches, path: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    file = TaskContext.get().partitionId()
    enc = tokens.encoder(path, spaced=True)
    end = np.array([END_ID], "<u4").tobytes()
    start = 0
    for batch in batches:
        docs, texts = batch.column(0), batch.column(1).to_pylist()
        for a, b in C.slices([len(t) for t in texts], 2 * C.SLICE_BYTES):
            data = [x + end for x in enc.encode(texts[a:b])]
            n = np.array([len(x) // 4 for x in data], np.int64)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            values = np.frombuffer(b"".join(data), "<i4")
            yield pa.RecordBatch.from_arrays(
                [docs[a:b], pa.array(np.full(b - a, file, np.int32)), pa.array(start + offsets[:-1].astype(np.int64)),
                 pa.array(n), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["doc_id", "file", "file_start", "n_tokens", "ids"])
            start += int(offsets[-1])


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, row_group_bytes: int = ROW_GROUP_BYTES,
                      page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of ``docs`` under ``path``."""
    vocabulary = vocabulary or tokens.vocabulary_path("byte_bpe_50k.json")
    ordered = C.id_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (C.map_batches(ordered, encode_sorted, FILE_SCHEMA, path=vocabulary).write
        .option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#file_start", "false")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path))


def read_token_files(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored columns plus ``start``, the place of a document's first id
    in the whole stream. ``columns`` leaves the rest unread; filters on
    ``doc_id`` reach the row groups and pages."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # one row of two numbers per file, so small whatever a file holds: a running sum over the file numbers gives each file's place in the stream
    per_file = files.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_file.select(F.col("file").alias("base_file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    out = (files.join(F.broadcast(bases), files["file"] == bases["base_file"])
           .withColumn("start", F.col("base") + F.col("file_start")))
    return out.select(*(columns or ["doc_id", "start", "n_tokens", "ids"]))


def checksums(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy().view("<u4")
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                         ["doc_id", "start", "n_tokens", "ids_crc32"])


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.scratch_path(spark, "token-files")
    write_token_files(C.table(spark, sf_dir, "documents"), path)
    return C.map_batches(read_token_files(spark, path), checksums,
                         "doc_id long, start long, n_tokens long, ids_crc32 long")
