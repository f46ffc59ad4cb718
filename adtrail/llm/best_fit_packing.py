"""Best-fit packing of token sequences (operator 3).

Documents are tokenised where they are read; only longer ones are cut, into
pieces of ``max_tokens``. Whole pieces fill a sequence each. All other pieces
are dealt evenly to tasks, and each task packs its share online: a fixed
number of open bins, a bitset keyed by free space finds the tightest bin that
takes a piece, and when all bins are open and none fits, the fullest closes.

Defined cases: a null text is the empty text (its end id alone is packed); a
null or repeated id is packed like any other row; an empty table gives no
rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm import tokens

MAX_TOKENS = 2048
OPEN_BINS = 256
ITEMS_PER_TASK = 32_768  # partly filled bins left at a task's end are under 1 % of its sequences
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(batches, path: str, max_tokens: int) -> Iterator[pa.RecordBatch]:
    enc = tokens.encoder(path, spaced=False)
    end = np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in C.slices([len(t) for t in texts], 4 * C.SLICE_BYTES):
            rows = []
            for doc, data in zip(ids[a:b], enc.encode(texts[a:b])):
                view = memoryview(data + end)
                n = len(view) // 4
                for piece, start in enumerate(range(0, n, max_tokens)):
                    length = min(max_tokens, n - start)
                    crc = zlib.crc32(view[4 * start:4 * (start + length)])
                    rows.append((doc, piece, start, length, crc, zlib.crc32(b"%d/%d" % (doc or 0, piece), crc)))
            cols = list(zip(*rows))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "deal"])


class BestFitBins:
    """Online packing with at most ``open_bins`` unclosed bins."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: dict[int, list[int]] = {}
        self.mask = 0  # bit f is set when an open bin has f places free
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return bin_

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of a piece of ``size`` <= capacity."""
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.n_open == self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
            bin_, free = self.n_bins, self.capacity
            self.n_bins += 1
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(bin_)
            self.mask |= 1 << left
            self.n_open += 1
        return bin_, self.capacity - free


def pack_partition(batches, max_tokens: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base = (TaskContext.get().partitionId() << 40) * 2
    bins = BestFitBins(max_tokens, open_bins)
    for batch in batches:
        placed = [bins.place(n) for n in batch.column("length").to_pylist()]
        out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        out.append(pa.array([base + 2 * b for b, _ in placed], pa.int64()))
        out.append(pa.array([o for _, o in placed], pa.int64()))
        yield pa.RecordBatch.from_arrays(
            out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def best_fit_packing(docs: DataFrame, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS,
                     items_per_task: int = ITEMS_PER_TASK, vocabulary: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` (see the module text)."""
    path = vocabulary or tokens.vocabulary_path("word_bpe_49k.json")
    pieces = C.map_batches(C.id_text(docs, id_col, text_col), cut_pieces, PIECES,
                           path=path, max_tokens=max_tokens)
    pieces = C.materialize(pieces, "pieces")
    whole = pieces.where(F.col("length") == max_tokens).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < max_tokens)
    tasks = max(1, -(-rest.count() // items_per_task))
    # dealt evenly whatever the ids; a fixed order makes a repeated task give the same bins
    dealt = rest.repartition(tasks).sortWithinPartitions("deal", "doc_id", "piece", "ids_crc32", "length")
    packed = C.map_batches(dealt, pack_partition, PACKED, max_tokens=max_tokens, open_bins=open_bins)
    return whole.unionByName(packed)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(C.table(spark, sf_dir, "documents"))
