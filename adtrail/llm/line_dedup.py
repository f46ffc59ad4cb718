"""Fuzzy line deduplication (operator 7).

Lines are normalised (A-Z lower-cased, digits made 0, ASCII punctuation
dropped) and equal ones collapsed. The others are compared by SimHash of
their words: lines at most ``MAX_DISTANCE`` bits apart agree on one of
``MAX_DISTANCE + 1`` blocks of the hash (pigeonhole), so lines are joined on
block and length class. Pairs are verified by edit similarity of the
normalised lines' characters, and of each connected group the first occurrence
(smallest document id, then line) is kept.

Lines with equal SimHash form a class; its members are verified against its
first line. Classes in the same block are compared with their neighbours in order first; near classes are
joined after that, only as far as their lines are in different groups by then, so a family of near copies
makes no pairs of all its lines. The result is that of
all pairs that meet, whatever is compared first.

A changed word flips many bits of a short line's SimHash, so blocks of the line itself
are joined too: lines meet that are equal but for one word, changed or left out (lines of at most
``SHORT_WORDS`` words), and that are equal but for any two of ``RUNS`` runs of their words (from ``LONG_WORDS`` words on).
So edits within one word (of a longer line: within two) are found by construction, whatever the length. Lines that meet so are
verified against two representatives, the least and the greatest by hash, so the pairs are at most twice the keys.

Representatives may be unlike lines that are alike, so then the lines that met (by key, or by equal or near SimHash) and
are still in different groups are compared with each other: of each key those outside its largest group with the rest. Pairs that
cannot be similar go by length and by which letters occur an odd number of times, before their texts are read.

Lines under ``MIN_WORDS`` words are never removed. Defined cases: a null text
stays null and an empty one empty; null ids sort after all others; rows with
the same id count as one document whose n-th lines are one occurrence when
they are equal; an empty table gives no rows; extra columns are passed on in
a struct, so names cannot clash.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from adtrail.llm import common as C
from adtrail.llm import shingles as S
from adtrail.llm.graph import connected_components

MIN_WORDS = 3
MAX_DISTANCE = 3            # of 64 bits
EDIT_SIMILARITY = 0.9       # 1 - edit distance in characters / characters of the longer line
SHORT_WORDS = 16            # up to so many words any one may differ
LONG_WORDS = 10             # from so many words (some 50 characters, so 5 edits) on two of
RUNS = 5                    # so many runs of words may differ
LENGTH_RATIO = 0.9          # characters; lengths further apart cannot be that similar
PLACE_LINES = 4096          # lines of a key that a task compares at a time

_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[:128] = [c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c if 97 <= c <= 122 or c == 10 else 32
                 for c in range(128)]
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)

# A byte's eight bits, highest first, as eight counters in memory order.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]

LINES = "rid long, doc_id long, line int, k1 long, k2 long, simhash long, size int, odd long"


class _Words:
    """Hashed normalised words of some texts and the lines they stand in."""

    def __init__(self, texts: list[str]):
        data = [t.encode() for t in texts]
        self.sizes = np.array([len(d) + 1 for d in data])
        buf = self.buf = _NORMAL[np.frombuffer(b"\n".join(data) + b"\n", np.uint8)]
        self.feeds = np.flatnonzero(buf == 10)
        blank = (buf == 32) | (buf == 10)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype(np.int8)))
        starts, ends = self.starts, self.ends = edge[0::2], edge[1::2]
        powers, inverses = self.powers, self.inverses = S._tables(len(buf) + 1)
        run = np.concatenate([[np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers[:len(buf)], dtype=np.uint64)])
        self.words = S.mix((run[ends] - run[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
        self.lines, self.first, self.n_words = np.unique(np.searchsorted(self.feeds, starts), return_index=True, return_counts=True)
        self.last = self.first + self.n_words

    def totals(self, h):
        return np.concatenate([[np.uint64(0)], np.cumsum(h * self.powers[:len(h)], dtype=np.uint64)])

    def ordered_hash(self, h):
        total = self.totals(h)
        return S.mix((total[self.last] - total[self.first]) * self.inverses[self.first] + self.n_words.astype(np.uint64))


def segment_keys(texts: list[str], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``key`` and the line's first hash: hashes of each line's words without the runs
    that may differ, and of all its words, as distinct pairs."""
    w = _Words(texts)
    own = w.ordered_hash(w.words)
    total = w.totals(w.words)
    keys, owners = [own[w.n_words >= min_words]], [own[w.n_words >= min_words]]

    def add(chosen, stretches):
        """Keys of the words in ``stretches`` (begin, end), moved up to follow each other."""
        first, size, key = w.first[chosen], 0, np.uint64(0)
        for begin, end in stretches:
            # a word that stood at ``begin`` now stands at ``first + size``
            key = key + (total[end] - total[begin]) * w.inverses[begin - size]
            size = size + (end - begin)
        keys.append(S.mix(key + size.astype(np.uint64)))
        owners.append(own[chosen])

    def cut(i):
        return w.first[chosen] + w.n_words[chosen] * i // RUNS

    for i in range(SHORT_WORDS):
        chosen = np.flatnonzero((w.n_words >= max(min_words, i + 1)) & (w.n_words <= SHORT_WORDS))
        word = w.first[chosen] + i
        add(chosen, [(w.first[chosen], word), (word + 1, w.last[chosen])])
    chosen = np.flatnonzero(w.n_words >= max(min_words, LONG_WORDS))
    for i, j in combinations(range(RUNS), 2):
        add(chosen, [(w.first[chosen], cut(i)), (cut(i + 1), cut(j)), (cut(j + 1), w.last[chosen])])
    pairs = np.unique(np.stack([np.concatenate(keys), np.concatenate(owners)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def line_table(texts: list[str]):
    """Of the lines with words: text number, line number, two 64-bit hashes of
    the normalised words in order, SimHash, words, normalised length in
    characters and a bitmap in which every character (by its first byte) flips one bit."""
    w = _Words(texts)
    buf, feeds, starts, ends, words = w.buf, w.feeds, w.starts, w.ends, w.words
    lines, first, n_words, last = w.lines, w.first, w.n_words, w.last

    simhash = np.zeros(len(lines), np.uint64)
    for a in range(0, len(lines), 8192):  # the words of some lines at a time
        b = min(len(lines), a + 8192)
        ones = _bit_counts(words[first[a]:last[b - 1]], first[a:b] - first[a], n_words[a:b])
        simhash[a:b] = np.packbits(2 * ones > n_words[a:b, None], axis=1).view(np.uint64)[:, 0]

    rest = np.concatenate([[0], np.cumsum((buf & 0xC0) == 0x80)])  # bytes that begin no character
    chars = ends - starts - (rest[ends] - rest[starts])
    spans = np.add.reduceat(chars, first) + n_words - 1 if len(lines) else np.zeros(0, np.int64)
    bits = np.where((buf == 32) | (buf == 10) | ((buf & 0xC0) == 0x80), np.uint64(0), np.uint64(1) << (buf & 63).astype(np.uint64))
    odd = np.bitwise_xor.reduceat(bits, starts[first]) if len(lines) else np.zeros(0, np.uint64)
    text_end = np.cumsum(w.sizes)
    text = np.searchsorted(text_end, feeds[lines], side="right")
    first_line = np.concatenate([[0], np.searchsorted(feeds, text_end[:-1])])
    return text, lines - first_line[text], w.ordered_hash(words), w.ordered_hash(S.mix(words * _SECOND)), simhash, n_words, spans, odd


def _bit_counts(words: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of a line's words have each of the 64 bits set. Eight counters
    of eight bits share a number, so pieces of at most 255 words are summed."""
    pieces = -(-counts // 255)
    line = np.repeat(np.arange(len(first)), pieces)
    piece = np.arange(len(line)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lanes = np.add.reduceat(_LANES[words.view(np.uint8).reshape(-1, 8)], first[line] + 255 * piece, axis=0)
    counters = lanes.view(np.uint8).reshape(len(line), 64)
    return np.add.reduceat(counters, np.cumsum(pieces) - pieces, axis=0, dtype=np.int32)


def normalised(line: str) -> str:
    """The text whose edit similarity counts."""
    mapped = _NORMAL[np.frombuffer(line.encode(), np.uint8)].tobytes().decode()
    return " ".join(w for w in mapped.split(" ") if w)


def line_rows(batches, min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rids, docs, all_texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        for a, b in C.slices([len(t) for t in all_texts]):
            text, line, k1, k2, simhash, n, size, odd = line_table(all_texts[a:b])
            keep = n >= min_words
            yield pa.RecordBatch.from_arrays(
                [rids[a:b].take(pa.array(text[keep])), docs[a:b].take(pa.array(text[keep])), pa.array(line[keep].astype(np.int32)),
                 *(pa.array(x[keep].view(np.int64)) for x in (k1, k2, simhash)), pa.array(size[keep].astype(np.int32)),
                 pa.array(odd[keep].view(np.int64))],
                ["rid", "doc_id", "line", "k1", "k2", "simhash", "size", "odd"])


def segment_rows(batches, min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in C.slices([len(t) for t in texts]):
            key, k1 = segment_keys(texts[a:b], min_words)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(k1.view(np.int64))], ["key", "k1"])


def _segment_places(texts: DataFrame, min_words: int) -> DataFrame:
    """``key, k1, low, high``: lines that are equal but for those runs, each with its group's two
    representatives. The groups are found by minima and maxima, so a task sends a row a key whatever
    its copies; only keys with different lines are met again by their members."""
    keyed = C.map_batches(texts.select("text"), segment_rows, "key long, k1 long", min_words=min_words)
    groups = keyed.groupBy("key").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low < high")
    groups = C.materialize(groups, "line-runs")
    return C.materialize(keyed.join(C.small(groups, groups.count()), "key").distinct(), "line-places")


def _open_pairs(places: DataFrame, grouped: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: lines of one key (``places``: key, k1) that are in different groups so far and may
    be similar. An edit flips at most two bits of ``odd``. ``grouped``: k1, size, odd, component."""
    met = places.join(grouped.select("k1", "size", "odd", "component"), "k1").select("key", "k1", "size", "odd", "component")
    parts = met.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    mixed = (parts.groupBy("key").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("n"), F.count(F.lit(1)).alias("parts"))
             .where("parts > 1").select("key", F.col("top.component").alias("main"), F.ceil(F.col("n") / PLACE_LINES).alias("deals")))
    rows = C.materialize(met.join(mixed, "key"), "open-lines")
    # a key with many lines is dealt to several tasks; its lines outside the largest group go to each
    outside = rows.where("component <> main").select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"),
        *[F.col(c).alias(f"{c}_a") for c in ("k1", "size", "odd", "component")])
    others = rows.select("key", F.expr("pmod(xxhash64(k1), deals)").alias("deal"), "main", "k1", "size", "odd", "component")
    edits = F.floor(F.greatest("size_a", "size") * F.lit(1 - similarity) + F.lit(1e-9))
    fit = (F.abs(F.col("size_a") - F.col("size")) <= edits) & (F.bit_count(F.col("odd_a").bitwiseXOR(F.col("odd"))) <= 2 * edits)
    # two lines outside the largest group meet once, not twice
    once = (F.col("component") == F.col("main")) | (F.col("k1_a") < F.col("k1"))
    return (outside.join(others, ["key", "deal"]).where((F.col("component_a") != F.col("component")) & once & fit)
            .select(F.least("k1_a", "k1").alias("a"), F.greatest("k1_a", "k1").alias("b")).distinct())


def pick_lines(batches) -> Iterator[pa.RecordBatch]:
    """``node, body``: normalised text of the asked lines of a document."""
    for batch in batches:
        nodes, bodies = [], []
        for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = text.split("\n")
            for x in asked:
                if x["line"] < len(lines):
                    nodes.append(x["node"])
                    bodies.append(normalised(lines[x["line"]]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(bodies, pa.string())], ["node", "body"])


def drop_lines(batches) -> Iterator[pa.RecordBatch]:
    """Texts without the lines listed."""
    for batch in batches:
        texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
        out, n_lines, n_removed = [], [], []
        for text, drop in zip(texts, gone):
            lines = [] if text is None else text.split("\n")
            if drop:
                bad = set(drop)
                text = "\n".join(x for i, x in enumerate(lines) if i not in bad)
            out.append(text)
            n_lines.append(len(lines))
            n_removed.append(len(set(drop)) if drop else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
            ["row", "text", "n_lines", "n_removed"])


def _surely_near(p: str, q: str, edits: int) -> bool:
    """Whether replacing the words that differ, place by place, takes few enough edits."""
    first, second = p.split(" "), q.split(" ")
    return len(first) == len(second) and sum(max(len(x), len(y)) for x, y in zip(first, second) if x != y) <= edits


def differing_parts(batches, similarity: float) -> Iterator[pa.RecordBatch]:
    """The pair's lines without their common begin and end, and how many
    edits they may need. An edit changes three 3-grams at most, so pairs that
    differ in more go unseen; of pairs that are surely near, nothing is left to compare."""
    for batch in batches:
        ends, first, second, limit = ([], []), [], [], []
        for a, b, p, q in zip(*(c.to_pylist() for c in batch.columns)):
            edits = int(max(len(p), len(q)) * (1 - similarity) + 1e-9)
            if _surely_near(p, q, edits):
                p = q = ""
            else:
                missing = Counter(map("".join, zip(p, p[1:], p[2:])))
                missing.subtract(map("".join, zip(q, q[1:], q[2:])))
                if sum(n for n in missing.values() if n > 0) > 3 * edits:
                    continue
            ends[0].append(a)
            ends[1].append(b)
            limit.append(edits)
            n = len(os.path.commonprefix((p, q)))
            p, q = p[n:], q[n:]
            n = len(os.path.commonprefix((p[::-1], q[::-1])))
            first.append(p[:len(p) - n])
            second.append(q[:len(q) - n])
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in ends), pa.array(first, pa.string()), pa.array(second, pa.string()),
                                          pa.array(limit, pa.int32())], ["a", "b", "p", "q", "limit"])


_BLOCKS = MAX_DISTANCE + 1
_WIDTH = 64 // _BLOCKS


def _length_class() -> Column:
    return F.floor(F.log(F.col("size")) / -np.log(LENGTH_RATIO)).cast("long")


def _block_keys(length: Column) -> list[Column]:
    """A key for each block of ``simhash`` and a length class."""
    return [F.shiftleft(F.lit(i).cast("long"), 56).bitwiseOR(F.shiftleft(length, _WIDTH)).bitwiseOR(
        F.shiftrightunsigned("simhash", i * _WIDTH).bitwiseAND((1 << _WIDTH) - 1)) for i in range(_BLOCKS)]


def _near(x: str, y: str) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= MAX_DISTANCE


def _block_neighbours(distinct: DataFrame) -> DataFrame:
    """``x, y``: of each block the SimHash values that are neighbours in order and near, so
    a row a value. ``distinct``: simhash, size."""
    classes = distinct.select("simhash", _length_class().alias("length")).distinct()
    # in order by the bits behind the block, then by those before it
    turned = [F.shiftrightunsigned("simhash", i * _WIDTH).bitwiseOR(F.shiftleft("simhash", 64 - i * _WIDTH)) if i else F.col("simhash")
              for i in range(_BLOCKS)]
    placed = classes.select(F.col("simhash").alias("x"), F.explode(F.array(*[
        F.struct(key.alias("key"), t.alias("turned")) for key, t in zip(_block_keys(F.col("length")), turned)])).alias("p"))
    before = F.lag("x").over(Window.partitionBy("p.key").orderBy("p.turned"))
    met = placed.withColumn("y", before).where(_near("x", "y"))
    return met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _block_pairs(grouped: DataFrame) -> DataFrame:
    """``x, y``: SimHash values at most MAX_DISTANCE bits apart that have
    lines of near lengths in different groups. ``grouped``: simhash, size, component."""
    classes = grouped.select("simhash", _length_class().alias("length"), "component").distinct()

    def keyed(shift):
        return classes.select(F.explode(F.array(*_block_keys(F.col("length") + shift))).alias("key"), "simhash", "component", F.lit(shift).alias("shift"))

    # a line meets those of its own length class, and those of the next
    x = keyed(0).unionByName(keyed(1)).select("key", F.col("simhash").alias("x"), F.col("component").alias("x_in"), "shift")
    y = keyed(0).select("key", F.col("simhash").alias("y"), F.col("component").alias("y_in"))
    once = (F.col("shift") == 1) & (F.col("x") != F.col("y")) | (F.col("x") < F.col("y"))
    met = x.join(y, "key").where(once & (F.col("x_in") != F.col("y_in")) & _near("x", "y"))
    return met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _links(pairs: DataFrame, distinct: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b: line hashes) that are similar enough, verified on the lines' texts."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = C.materialize(pairs, "line-pairs")
    if pairs.isEmpty():
        return pairs
    nodes = pairs.select(F.col("a").alias("k1")).unionByName(pairs.select(F.col("b").alias("k1"))).distinct()
    asked = C.materialize(distinct.join(nodes, "k1", "left_semi").groupBy(F.col("head_rid").alias("asked_id")).agg(
        F.collect_list(F.struct(F.col("k1").alias("node"), F.col("head.line").alias("line"))).alias("asked")), "asked")
    ids = asked.select(F.col("asked_id").alias("rid"))
    wanted = texts.select("rid", "text").join(C.small(ids, asked.count()), "rid", "left_semi")
    bodies = C.map_batches(wanted.join(asked, F.col("rid") == F.col("asked_id")).select("text", "asked"),
                           pick_lines, "node long, body string").groupBy("node").agg(F.min("body").alias("body"))
    bodies = C.materialize(bodies, "bodies")
    both = (pairs.join(bodies.select(F.col("node").alias("a"), F.col("body").alias("p")), "a")
            .join(bodies.select(F.col("node").alias("b"), F.col("body").alias("q")), "b").select("a", "b", "p", "q"))
    both = C.map_batches(both, differing_parts, "a long, b long, p string, q string, limit int", similarity=similarity)
    return C.materialize(both.where(F.expr("levenshtein(p, q, limit)") >= 0).select("a", "b"), "line-links")


def repeated_lines(texts: DataFrame, min_words: int = MIN_WORDS, similarity: float = EDIT_SIMILARITY) -> DataFrame:
    """``gone_id, gone``: the numbers of the lines to remove. ``texts``: rid,
    doc_id, text."""
    lines = C.materialize(C.map_batches(texts, line_rows, LINES, min_words=min_words), "lines")
    # null ids last
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line")
    distinct = C.materialize(lines.groupBy("k1", "k2").agg(
        F.min("simhash").alias("simhash"), F.min("size").alias("size"), F.min("odd").alias("odd"), F.min(place).alias("head"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "line", "rid"))["rid"].alias("head_rid"),
        F.count(F.lit(1)).alias("copies")), "distinct-lines")
    classes = distinct.groupBy("simhash").agg(F.min(F.struct("head", "k1")).alias("r"), F.count(F.lit(1)).alias("members"))
    classes = C.materialize(classes.select("simhash", F.col("r.k1").alias("rep"), "members"), "line-classes")

    # 1. lines against representatives, classes against their neighbours
    rep = classes.select("simhash", "rep")
    between = (_block_neighbours(distinct).join(rep.select(F.col("simhash").alias("x"), F.col("rep").alias("a")), "x")
               .join(rep.select(F.col("simhash").alias("y"), F.col("rep").alias("b")), "y").select("a", "b"))
    several = classes.where("members > 1").select("simhash", "rep")
    same_hash = distinct.join(several, "simhash").select("simhash", "rep", "k1")
    within = same_hash.where(F.col("k1") != F.col("rep")).select(F.col("k1").alias("a"), F.col("rep").alias("b"))
    runs = _segment_places(texts, min_words)
    by_runs = runs.select(F.col("k1").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a <> b")
    groups = connected_components(_links(between.unionByName(within).unionByName(by_runs), distinct, texts, similarity))

    # 2. lines that met and are in different groups
    grouped = C.materialize(distinct.join(groups, distinct["k1"] == groups["node"], "left")
                            .select("k1", "simhash", "size", "odd", F.coalesce("component", "k1").alias("component")), "grouped-lines")
    near = C.materialize(_block_pairs(grouped), "near-hashes")
    of_pairs = (near.select(F.explode(F.array("x", "y")).alias("simhash"), F.xxhash64("x", "y").alias("key"))
                .join(distinct.select("simhash", "k1"), "simhash").select("key", "k1"))
    places = runs.select("key", "k1").unionByName(same_hash.select(F.col("simhash").alias("key"), "k1")).unionByName(of_pairs).distinct()
    more = _links(_open_pairs(places, grouped, similarity), distinct, texts, similarity)
    if not more.isEmpty():
        stars = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = connected_components(stars.unionByName(more))

    repeated = distinct.join(groups, distinct["k1"] == groups["node"], "left").where("component IS NOT NULL OR copies > 1")
    repeated = repeated.select("k1", "k2", "head", F.coalesce("component", "k1").alias("component"))
    kept = repeated.groupBy("component").agg(F.min("head").alias("keep"))
    target = repeated.join(kept, "component").select("k1", "k2", "keep")
    gone = (lines.join(target, ["k1", "k2"])
            .where(~(F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("line") == F.col("keep.line")))))
    return gone.groupBy(F.col("rid").alias("gone_id")).agg(F.collect_list("line").alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns to keep, all but the text by default),
    ``text`` without repeated lines, ``n_lines`` and ``n_removed``."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    # rows equal in id and text share a key and keep the same lines
    rid = F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), rid.alias("rid"), F.col(f"`{text_col}`").alias("text"))
    keyed = C.id_text(docs, id_col, text_col).select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")
    gone = repeated_lines(keyed, min_words)
    joined = base.join(gone, base["rid"] == gone["gone_id"], "left").select("row", "text", "gone")
    schema = StructType([joined.schema["row"], StructField("text", StringType()), StructField("n_lines", LongType()),
                         StructField("n_removed", LongType())])
    return C.map_batches(joined, drop_lines, schema)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(C.table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
