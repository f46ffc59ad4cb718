"""Ranked lexical search over K2-treaps (operator 11).

Index: documents are cut into shards of about ``SHARD_BYTES`` of text, each
made in one task without a shuffle. A shard's grid has a row for each of its
terms (the most frequent first) and a column for each of its documents (in id
order); a point is a posting and holds its impact. The grid is a quadtree: a
cell stores the largest impact below it and which of its four quarters hold
points; a cell of one point stores the point and is not divided further. Cells
lie level by level, so a cell's children are found by counting bits. All terms
of all documents are held, whatever is asked later.

Search: an item's terms are rows of the grid. A range of columns has at most
one cell a row; the sum of weight times largest impact over these cells bounds
every document of the range. Ranges are split best first, all rows of an item
descending together, and a range goes when its bound cannot reach the ranks
wanted (for equal scores: when its least id cannot). A task carries what it has
found from shard to shard, so later shards are cut earlier; nothing is cut that
could be in the result. Items travel in blocks of about ``ITEMS_PER_BLOCK``.

Impacts and weights follow the module's fixed formulas (see ``shard_index`` and
``item_terms``); all but the logarithm are integers.

Defined cases: a null text has no term; an item without known terms has no
result; null ids come last among equal scores; rows with one id are documents
(or items) of their own; empty tables give no rows; columns other than id and
text are ignored.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtrail.llm import common as C

TOP = 10
SHARD_BYTES = 8 << 20
ITEMS_PER_BLOCK = 1000
BROADCAST_BLOCKS = 32  # blocks of items sent to every task; more are joined by shuffle
ITEMS_HELD = 20_000  # items whose best documents a task carries on; beyond that it sends them and begins anew
SPLIT_AT_ONCE = 48  # ranges split in one step
NO_ID = np.iinfo(np.int64).max  # null ids come last

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = (string.ascii_letters + string.digits).encode() + bytes(range(128, 256))
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _TERM_BYTES else 32 for c in range(256))

# below: number of set bits of a mask under a quarter's bit
_BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int32)
_BITS = np.array([bin(m).count("1") for m in range(16)], np.int32)

SHARD = ("shard long, height int, doc_ids binary, terms array<string>, df array<int>, "
         "masks binary, maxima binary, leaf_rows binary, leaf_cols binary")


def term_list(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def count_terms(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [len(term_list(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([sum(map(bool, sizes))], pa.int64()), pa.array([sum(sizes)], pa.int64())],
                                         ["docs", "terms"])


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at the even places of 64-bit ones."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build_treap(rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, height: int) -> tuple:
    """``masks, maxima, leaf_rows, leaf_cols`` of distinct points, level by level."""
    keys = (_spread(rows) << np.uint64(1)) | _spread(cols)
    order = np.argsort(keys)
    keys, rows, cols, impacts = keys[order], rows[order], cols[order], impacts[order]
    masks, maxima, leaf_rows, leaf_cols = [], [], [], []
    for level in range(height + 1):
        if not len(keys):
            break
        cells = keys >> np.uint64(2 * (height - level))
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        maxima.append(np.maximum.reduceat(impacts, starts))
        alone = sizes == 1
        if level < height:
            quarter = (keys >> np.uint64(2 * (height - level - 1))).astype(np.uint8) & 3
            mask = np.bitwise_or.reduceat(np.left_shift(1, quarter).astype(np.uint8), starts)
            mask[alone] = 0
        else:
            mask = np.zeros(len(starts), np.uint8)
        masks.append(mask)
        leaf_rows.append(rows[starts[alone]])
        leaf_cols.append(cols[starts[alone]])
        left = np.repeat(~alone, sizes)
        keys, rows, cols, impacts = keys[left], rows[left], cols[left], impacts[left]
    join = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in (masks, maxima, leaf_rows, leaf_cols)]
    return join[0].astype(np.uint8), *(x.astype(np.int32) for x in join[1:])


class ShardBuilder:
    """Term occurrences of some documents."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.docs: list[int] = []
        self.parts: list[np.ndarray] = []

    def add(self, doc: int | None, text: bytes) -> None:
        terms = term_list(text)
        self.docs.append(NO_ID if doc is None else doc)
        self.parts.append(np.fromiter(map(self.ids.__getitem__, terms), np.int32, len(terms)))
        self.bytes += len(text)

    def row(self, docs: int, terms: int) -> pa.RecordBatch:
        """``docs`` and ``terms`` are the corpus totals; a document's m and a posting's impact are
        100 - 90 + (90 * n * docs) div terms and (10^9 * tf) div (1000 * tf + 8 * m)."""
        sizes = [len(p) for p in self.parts]
        order = np.argsort(np.array(self.docs, np.int64), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        m = np.array([100 - 90 + (90 * n * docs) // max(terms, 1) for n in sizes], np.int64)[order]
        n_terms = max(len(self.ids), 1)
        occurrences = np.repeat(place, sizes) * n_terms + np.concatenate(self.parts)
        points, tf = np.unique(occurrences, return_counts=True)
        cols, words = points // n_terms, points % n_terms
        df = np.bincount(words, minlength=len(self.ids))
        by_df = np.argsort(-df, kind="stable")
        row_of = np.empty(len(by_df), np.int64)
        row_of[by_df] = np.arange(len(by_df))
        names = list(self.ids)
        height = max(len(names) - 1, len(sizes) - 1, 1).bit_length()
        impacts = (10**9 * tf) // (1000 * tf + 8 * m[cols])
        tree = build_treap(row_of[words], cols, impacts, height)
        held = [np.array(self.docs, np.int64)[order], *tree]
        binary = [pa.array([x.tobytes()], pa.binary()) for x in held]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.number], pa.int64()), pa.array([height], pa.int32()), binary[0],
             pa.array([[names[i].decode() for i in by_df]], pa.list_(pa.string())),
             pa.array([df[by_df].tolist()], pa.list_(pa.int32())), *binary[1:]],
            ["shard", "height", "doc_ids", "terms", "df", "masks", "maxima", "leaf_rows", "leaf_cols"])


def shard_index(batches, docs: int, terms: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    numbers = count(TaskContext.get().partitionId() << 32)
    shard = ShardBuilder(next(numbers))
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            shard.add(doc, text)
            if shard.bytes >= shard_bytes:
                yield shard.row(docs, terms)
                shard = ShardBuilder(next(numbers))
    if shard.ids:
        yield shard.row(docs, terms)


class Treap:
    """A shard as read back."""

    def __init__(self, row: dict):
        self.height = row["height"]
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.masks = np.frombuffer(row["masks"], np.uint8)
        self.maxima = np.frombuffer(row["maxima"], np.int32)
        self.leaf_rows = np.frombuffer(row["leaf_rows"], np.int32)
        self.leaf_cols = np.frombuffer(row["leaf_cols"], np.int32)
        # a cell's children follow those of the cells before it; so do leaves
        self.child = np.cumsum(_BITS[self.masks], dtype=np.int32) + 1 - _BITS[self.masks]
        self.leaf = np.cumsum(self.masks == 0, dtype=np.int32) - 1

    def split(self, rows, weights, level, col, cell) -> tuple:
        """Both halves of each column range: the range's column prefix, its
        cell in each row (-1: none), and the bound. Rows run along axis 1."""
        shift = self.height - 1 - level
        here = np.maximum(cell, 0)
        mask = self.masks[here]
        leaf = (mask == 0) & (cell >= 0)
        at = self.leaf[here]
        own = leaf & (self.leaf_rows[at] == rows)  # a lone point may lie in another row of the cell
        leaf_bit = np.where(own, (self.leaf_cols[at] >> shift[:, None]) & 1, 2)
        row_bit = (rows >> shift[:, None]) & 1
        halves, bounds = [], []
        for half in (0, 1):
            quarter = 2 * row_bit + half
            below = self.child[here] + _BELOW[mask, quarter]
            inner = (cell >= 0) & ((mask >> quarter) & 1).astype(bool)
            kept = np.where(inner, below, np.where(leaf_bit == half, cell, -1))
            halves.append(kept)
            bounds.append((np.where(kept >= 0, self.maxima[np.maximum(kept, 0)], 0) * weights).sum(axis=1))
        return (np.concatenate([2 * col, 2 * col + 1]), np.concatenate(halves), np.concatenate(bounds))

    def search(self, rows: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer every document to ``best`` that could enter it."""
        level, col = np.zeros(1, np.int64), np.zeros(1, np.int64)
        cell = np.zeros((1, len(rows)), np.int32)
        bound = np.array([int((self.maxima[0] * weights).sum())])
        while len(bound):
            if len(bound) > SPLIT_AT_ONCE:
                first = np.argpartition(-bound, SPLIT_AT_ONCE)
                now, later = first[:SPLIT_AT_ONCE], first[SPLIT_AT_ONCE:]
            else:
                now, later = np.arange(len(bound)), np.arange(0)
            depth = np.concatenate([level[now]] * 2) + 1
            to_col, to_cell, to_bound = self.split(rows, weights, level[now], col[now], cell[now])
            done = (depth == self.height) & (to_bound > 0)
            if done.any():
                best.offer(to_bound[done], self.doc_ids[to_col[done]])
            going = depth < self.height
            level = np.concatenate([level[later], depth[going]])
            col = np.concatenate([col[later], to_col[going]])
            cell = np.concatenate([cell[later], to_cell[going]])
            bound = np.concatenate([bound[later], to_bound[going]])
            first_col = col << (self.height - level)
            least_id = self.doc_ids[np.minimum(first_col, len(self.doc_ids) - 1)]
            hope = best.open_to(bound, least_id)
            if not hope.all():
                level, col, cell, bound = level[hope], col[hope], cell[hope], bound[hope]


class Best:
    """The ``top`` best documents of an item so far: by score, then by id."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def open_to(self, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which documents, or ranges by bound and least id, could still enter."""
        if len(self.scores) < self.top:
            return scores > 0
        return (scores > self.scores[-1]) | ((scores == self.scores[-1]) & (ids < self.ids[-1]))

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.top]
        self.scores, self.ids = scores[order], ids[order]


def search_shards(batches, top: int) -> Iterator[pa.RecordBatch]:
    """Each row holds a shard and a block of items."""
    found: dict[int, Best] = {}
    treap = number = None
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            if one.column("shard")[0].as_py() != number:
                number = one.column("shard")[0].as_py()
                names = ("height", "doc_ids", "masks", "maxima", "leaf_rows", "leaf_cols")
                treap = Treap({c: one.column(c)[0].as_py() for c in names})
                names = one.column("terms").flatten()
            asked = one.column("asked").flatten()
            at = pc.index_in(asked.field("term"), value_set=names)
            place = np.asarray(at.fill_null(-1))
            items, weights = np.asarray(asked.field("item")), np.asarray(asked.field("weight"))
            known = (place >= 0) & (weights > 0)
            items, place, weights = items[known], place[known].astype(np.int64), weights[known]
            order = np.argsort(items, kind="stable")
            items, place, weights = items[order], place[order], weights[order]
            starts = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else []
            for a, b in zip(starts, [*starts[1:], len(items)]):
                best = found.setdefault(int(items[a]), Best(top))
                treap.search(place[a:b], weights[a:b], best)
            if len(found) > ITEMS_HELD:
                yield found_rows(found)
                found.clear()
    yield found_rows(found)


def found_rows(found: dict[int, Best]) -> pa.RecordBatch:
    rows = [(item, None if doc == NO_ID else int(doc), int(score))
            for item, best in found.items() for doc, score in zip(best.ids, best.scores)]
    cols = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item", "doc_id", "score"])


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return C.id_text(df, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))


def corpus_totals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and terms with repeats."""
    parts = C.map_batches(_texts(docs, id_col, text_col), count_terms, "docs long, terms long")
    row = parts.agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def build_index(docs: DataFrame, totals: tuple[int, int], id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard (see the module text); write it once (``kept_index``), search it often."""
    return C.map_batches(_texts(docs, id_col, text_col), shard_index, SHARD, docs=totals[0], terms=totals[1],
                         shard_bytes=shard_bytes)


def kept_index(docs: DataFrame, totals: tuple[int, int], **params) -> DataFrame:
    """The index in the shared folder. A shard is a row group, so that a task holds one
    shard at a time, however many of them its part of the documents makes."""
    return C.materialize(build_index(docs, totals, **params), "search-index", group_rows=1)


def item_terms(items: DataFrame, index: DataFrame, n_docs: int, id_col: str = "item_id",
               text_col: str = "text") -> DataFrame:
    """Distinct terms of each item row that the index holds, with their weight
    floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))): ``item, item_id, term, weight``."""
    text = F.translate(F.col(f"`{text_col}`").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    terms = (items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("item_id"),
                          F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("terms"))
             .select("item", "item_id", F.explode("terms").alias("term")))
    terms = C.materialize(terms, "search-terms")
    asked = terms.select("term").distinct()
    held = (index.select(F.explode(F.arrays_zip("terms", "df")).alias("t"))
            .select(F.col("t.terms").alias("term"), F.col("t.df").alias("df")))
    df = held.join(C.small(asked, asked.count()), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0))))
    return terms.join(df, "term").select("item", "item_id", "term", weight.cast("long").alias("weight"))


def search(index: DataFrame, terms: DataFrame, top: int = TOP, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """``item, item_id, rank, doc_id, score``: each item's ``top`` documents."""
    terms = C.materialize(terms, "search-items")
    keys = terms.select("item", "item_id").distinct()
    n_blocks = max(1, -(-keys.count() // items_per_block))
    blocks = (terms.groupBy(F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("block"))
              .agg(F.collect_list(F.struct("item", "term", "weight")).alias("asked")))
    if n_blocks <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    pairs = (index.drop("df").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
             .join(blocks, "block").drop("block"))
    found = C.map_batches(pairs, search_shards, "item long, doc_id long, score long", top=top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(keys, "item").select("item", "item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")
    totals = corpus_totals(docs)
    index = kept_index(docs, totals)
    found = search(index, item_terms(items, index, totals[0]))
    return found.select("item_id", "rank", "doc_id", "score")


_TERMS = (f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', "
          f"'{string.ascii_lowercase}'), '{TERM}')")
OP11_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
t AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
       FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w FROM df, t),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), t GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {TOP}
"""
