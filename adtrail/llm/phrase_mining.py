"""Phrase collocation mining by SETM (operator 13).

An occurrence relation holds one entry per word occurrence, in order of piece
and position. It is stored as sorted columns, one row per block of documents:
places (a piece break takes a place of its own, so adjacent places are adjacent
positions of one piece) and items. Length k + 1 comes from length k as in SETM:

1. a merge join of the relation of k-phrases with the relation of words, on
   place + k, gives the occurrences of (k-phrase, next word);
2. a group count over all blocks keeps the groups that reach the least count. A
   block sends each group once, dealt by a hash of the group, as sorted and packed
   columns, one row for each part; a part is counted in one task, which holds few of
   all groups, and no group has more entries than there are blocks;
3. a semi-join with the frequent groups leaves the relation of (k + 1)-phrases. The task
   that has counted a part answers each block: one bit for each group that the block sent,
   and the numbers of the frequent ones. The relation is written to the shared
   folder before the next length begins.

A phrase is at most as frequent as each of its parts, so nothing that reaches
the least count is lost. Scores, the rule for phrases inside longer ones and
the ranks are plain DataFrame steps on the frequent groups.

Defined cases: a null text is empty; a null language is ``und``, the same as
that text; rows are counted one by one whatever their ids, so repeated rows
count again; texts without words, and empty tables, give no rows; ties in
score and count go by the phrase's UTF-8 bytes; columns other than text and
language are ignored.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtrail.llm import common as C

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SCALE = 2_000_000
COVER = (100, 80)  # a phrase goes when 100 * f(longer) >= 80 * f(phrase)
NO_LANG = "und"
BLOCK_BYTES = 6 << 20  # text of a block: its relation is a few numbers a word in one task
PART_GROUPS = 4 << 20  # groups, as sent by the blocks, that a task counts at most; they are some dozen bytes each
ROWS_PER_BATCH = 1 << 16

BREAK = b"."
BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(string.ascii_uppercase.encode() + BREAKS,
                       string.ascii_lowercase.encode() + BREAK * len(BREAKS))

WORDS = "block long, langs array<string>, words array<string>, counts array<long>, items binary"
RELATION = "block long, words binary, word_ids binary, phrases binary, phrase_ids binary"
SENT = "part int, block long, groups binary"
COUNTED = "part int, block long, held binary, ids binary, frequent binary"
GROUPS = "left long, item long, id long, a long"


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, of numbers not below zero: the bytes in use, byte by byte of all numbers."""
    columns = [np.ascontiguousarray(c, np.int64) for c in columns]
    widths = [max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 0 for c in columns]
    planes = b"".join(c.view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for c, w in zip(columns, widths))
    return len(columns[0]).to_bytes(8, "little") + bytes(widths) + pa.compress(planes, "zstd", asbytes=True)


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    size, widths = int.from_bytes(data[:8], "little"), data[8:8 + columns]
    planes = np.frombuffer(pa.decompress(data[8 + columns:], size * sum(widths), "zstd", asbytes=True), np.uint8)
    out, start = [], 0
    for w in widths:
        column = np.zeros((size, 8), np.uint8)
        column[:, :w] = planes[start:start + size * w].reshape(w, size).T
        out.append(column.view(np.int64).reshape(-1))
        start += size * w
    return out


def _gaps(sorted_numbers: np.ndarray) -> np.ndarray:
    """Sorted numbers by their distances, which are small."""
    return np.diff(sorted_numbers, prepend=0)


class Block:
    """Word occurrences of some documents under numbers of their own; 0 is a break."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.next = count(1).__next__
        self.ids: dict[str, defaultdict] = {}
        self.parts: list[np.ndarray] = []

    def add(self, text: bytes, lang: str) -> None:
        ids = self.ids.get(lang)
        if ids is None:
            ids = self.ids[lang] = defaultdict(self.next, {BREAK: 0})
        words = text.translate(FOLD).replace(BREAK, b" . ").split()  # blanks and tabs are the only white space left
        words.append(BREAK)
        self.parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
        self.bytes += len(text)

    def row(self) -> pa.RecordBatch:
        items = np.concatenate(self.parts)
        size = 1 + sum(len(d) - 1 for d in self.ids.values())
        langs, words = [""] * size, [b""] * size
        for lang, ids in self.ids.items():
            for word, i in ids.items():
                langs[i], words[i] = lang, word
        counts = np.bincount(items, minlength=size)[1:].tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.number], pa.int64()), pa.array([langs[1:]], pa.list_(pa.string())),
             pa.array([[w.decode() for w in words[1:]]], pa.list_(pa.string())),
             pa.array([counts], pa.list_(pa.int64())), pa.array([_pack(items)], pa.binary())],
            ["block", "langs", "words", "counts", "items"])


def word_blocks(batches, block_bytes: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    numbers = count(TaskContext.get().partitionId() << 32)
    block = Block(next(numbers))
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            block.add(text, lang)
            if block.bytes >= block_bytes:
                yield block.row()
                block = Block(next(numbers))
    if block.parts:
        yield block.row()


def _relation_row(block: int, word_at, word, word_ids, at, phrase, phrase_ids) -> pa.RecordBatch:
    """Words and phrases are numbered within the block, in the order of their ids."""
    cols = [_pack(_gaps(word_at), word), _pack(_gaps(word_ids)), _pack(_gaps(at), phrase), _pack(_gaps(phrase_ids))]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64())] + [pa.array([c], pa.binary()) for c in cols],
        ["block", "words", "word_ids", "phrases", "phrase_ids"])


def _rows(batches) -> Iterator[dict]:
    """Rows one at a time: they may be megabytes each."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def frequent_words(batches) -> Iterator[pa.RecordBatch]:
    """Semi-join of a block's occurrences with the frequent words it holds."""
    none = np.zeros(0, np.int64)
    for row in _rows(batches):
        items, = _unpack(row["items"], 1)
        local, ids = np.array(row["local"], np.int64), np.array(row["id"], np.int64)
        order = np.argsort(ids)
        keep = np.full(int(items.max()) + 1, -1, np.int64)
        keep[local[order]] = np.arange(len(order))
        word = keep[items]
        at = np.flatnonzero(word >= 0)
        yield _relation_row(row["block"], at, word[at], ids[order], none, none, none)


class Joined:
    """Merge join of a block's phrases of ``k - 1`` words with its words at
    place + k - 1. ``pair`` numbers the groups (phrase, word) within the block, in the order of their ids."""

    def __init__(self, row: dict, k: int):
        gaps, self.word = _unpack(row["words"], 2)
        self.word_at, self.word_ids = np.cumsum(gaps), np.cumsum(_unpack(row["word_ids"], 1)[0])
        if k == 2:
            self.at, phrase, self.phrase_ids = self.word_at, self.word, self.word_ids
        else:
            gaps, phrase = _unpack(row["phrases"], 2)
            self.at, self.phrase_ids = np.cumsum(gaps), np.cumsum(_unpack(row["phrase_ids"], 1)[0])
        to = np.searchsorted(self.word_at, self.at + (k - 1))
        to[to == len(self.word_at)] = 0  # no later word: the first is never adjacent
        met = self.word_at[to] == self.at + (k - 1) if len(self.word_at) else np.zeros(0, bool)
        self.at = self.at[met]
        self.pair = phrase[met] * len(self.word_ids) + self.word[to[met]]

    def ids(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n_words = max(len(self.word_ids), 1)
        return self.phrase_ids[pairs // n_words], self.word_ids[pairs % n_words]


def dealt(left: np.ndarray, item: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts that these groups go to, by a hash of each group: the order that puts
    the groups by part, the parts that get any, and where each begins in that order."""
    x = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + item.astype(np.uint64)
    for shift in (32, 29):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(31)
    part = (x % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    return order, part[starts], starts


def sent_groups(batches, k: int, parts: int) -> Iterator[pa.RecordBatch]:
    """A block's groups with their counts: a row for each part that gets some."""
    for row in _rows(batches):
        joined = Joined(row, k)
        pairs, counts = np.unique(joined.pair, return_counts=True)
        left, item = joined.ids(pairs)
        order, to, starts = dealt(left, item, parts)
        left, item, counts = left[order], item[order], counts[order]
        packed = [_pack(_gaps(left[a:b]), item[a:b], counts[a:b]) for a, b in zip(starts, [*starts[1:], len(left)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(to.astype(np.int32)), pa.array(np.full(len(to), row["block"], np.int64)), pa.array(packed, pa.binary())],
            ["part", "block", "groups"])


def _keys(left: np.ndarray, item: np.ndarray) -> np.ndarray:
    """One number a group, in the order of (left, item)."""
    size = int(item.max()) + 1
    if int(left.max()) >= (1 << 63) // size - 1:  # too large for one number: by their ranks in the part
        left, item = (np.unique(x, return_inverse=True)[1] for x in (left, item))
        size = int(item.max()) + 1
    return left * size + item


def count_part(part: int, parts: int, sent: list[tuple[int, bytes]], min_count: int) -> Iterator[pa.RecordBatch]:
    """The frequent groups of a part (a row without a block), and an answer to each block.
    Ids are dealt out to the parts in turn, so they stay close."""
    columns = [_unpack(groups, 3) for _, groups in sent]
    sizes = [len(c[0]) for c in columns]
    left = np.concatenate([np.cumsum(c[0]) for c in columns])
    item, counts = (np.concatenate([c[i] for c in columns]) for i in (1, 2))
    del columns
    keys = _keys(left, item)
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.add.reduceat(counts[order], starts)
    frequent = total >= min_count
    number = np.where(frequent, np.cumsum(frequent) - 1, -1)
    of_entry = np.empty(len(order), np.int64)
    of_entry[order] = np.repeat(number, np.diff(np.append(starts, len(order))))
    first = order[starts[frequent]]
    yield _answer(part, [None], [None], [None], [_pack(left[first], item[first], number[frequent] * parts + part, total[frequent])])
    ends = np.cumsum(sizes)
    for a in range(0, len(sent), 1000):
        held, ids = [], []
        for end, size in zip(ends[a:a + 1000], sizes[a:a + 1000]):
            mine = of_entry[end - size:end]
            held.append(np.packbits(mine >= 0).tobytes())
            ids.append(_pack(_gaps(mine[mine >= 0])))
        yield _answer(part, [block for block, _ in sent[a:a + 1000]], held, ids, [None] * len(held))


def _answer(part: int, blocks: list, held: list, ids: list, frequent: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(blocks), pa.int32()), pa.array(blocks, pa.int64()), pa.array(held, pa.binary()),
         pa.array(ids, pa.binary()), pa.array(frequent, pa.binary())], ["part", "block", "held", "ids", "frequent"])


def count_groups(batches, parts: int, min_count: int) -> Iterator[pa.RecordBatch]:
    sent: defaultdict[int, list] = defaultdict(list)
    for batch in batches:
        for part, block, groups in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "groups"))):
            sent[part].append((block, groups))
    for part in list(sent):
        yield from count_part(part, parts, sent.pop(part), min_count)


def frequent_groups(batches) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        columns = _unpack(row["frequent"], 4)
        for a in range(0, len(columns[0]), ROWS_PER_BATCH):
            yield pa.RecordBatch.from_arrays([pa.array(c[a:a + ROWS_PER_BATCH]) for c in columns], ["left", "item", "id", "a"])


def extended(batches, k: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Semi-join of the joined occurrences with the frequent groups, by the answers of the parts
    that the block's groups were sent to. Only words that may follow a phrase that is left stay
    in the word relation."""
    for row in _rows(batches):
        joined = Joined(row, k)
        pairs, pair = np.unique(joined.pair, return_inverse=True)
        order, to, starts = dealt(*joined.ids(pairs), parts)
        begins = dict(zip(to.tolist(), zip(starts, [*starts[1:], len(pairs)])))
        kept, ids = [], []
        for answer in row["answers"]:
            a, b = begins[answer["part"]]
            kept.append(order[a:b][np.unpackbits(np.frombuffer(answer["held"], np.uint8), count=b - a).astype(bool)])
            ids.append(np.cumsum(_unpack(answer["ids"], 1)[0]) * parts + answer["part"])
        kept, ids = np.concatenate(kept), np.concatenate(ids)
        by_id = np.argsort(ids)
        local = np.full(len(pairs), -1, np.int64)
        local[kept[by_id]] = np.arange(len(kept))
        phrase = local[pair]
        held = phrase >= 0
        at = joined.at[held]
        follow = np.isin(joined.word_at, at + k, assume_unique=True)
        yield _relation_row(row["block"], joined.word_at[follow], joined.word[follow], joined.word_ids,
                            at, phrase[held], ids[by_id])


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     text_col: str = "text", lang_col: str = "lang",
                     block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``max_words`` words with at least ``min_count``
    occurrences (``lang, k, phrase, a``), and the words of each language (``lang, n``)."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"))
    blocks = C.materialize(C.map_batches(texts, word_blocks, WORDS, block_bytes=block_bytes), "phrase-words", group_rows=1)
    words = (blocks.select("block", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("pos", "w"))
             .select("block", (F.col("pos") + 1).alias("local"), F.col("w.langs").alias("lang"),
                     F.col("w.words").alias("phrase"), F.col("w.counts").alias("n")))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = _numbered(words.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count))
    levels = [known]
    found = words.join(C.small(known, known.count()).select("lang", "phrase", "id"), ["lang", "phrase"])
    lists = (found.groupBy("block").agg(F.collect_list(F.struct("local", "id")).alias("held"))
             .select("block", F.col("held.local").alias("local"), F.col("held.id").alias("id")))
    relation = _kept(C.map_batches(blocks.select("block", "items").join(lists, "block"), frequent_words, RELATION), 1)
    for k in range(2, max_words + 1):
        parts = _parts(levels[-1])
        sent = C.map_batches(relation, sent_groups, SENT, k=k, parts=parts).repartitionById(parts, F.col("part"))
        counted = C.materialize(C.map_batches(sent, count_groups, COUNTED, parts=parts, min_count=min_count), f"phrases-counted-{k}")
        groups = C.map_batches(counted.where(F.col("block").isNull()).select("frequent"), frequent_groups, GROUPS)
        left = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"))
        item = known.select(F.col("id").alias("item"), F.col("phrase").alias("tail"))
        levels.append(C.materialize(groups.join(left, "left").join(item, "item")
                                    .select("lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "a", "id"), "phrase-groups"))
        if k < max_words:
            answers = (counted.where(F.col("block").isNotNull()).groupBy("block")
                       .agg(F.collect_list(F.struct("part", "held", "ids")).alias("answers")))
            relation = _kept(C.map_batches(relation.join(answers, "block"), extended, RELATION, k=k, parts=parts), k)
    phrases = [f.select("lang", F.lit(i + 1).alias("k"), "phrase", "a") for i, f in enumerate(levels)]
    out = phrases[0]
    for p in phrases[1:]:
        out = out.unionByName(p)
    return out, totals


def _kept(relation: DataFrame, k: int) -> DataFrame:
    return C.materialize(relation, f"phrases-{k}", group_rows=1)


def _parts(level: DataFrame) -> int:
    """Parts of the groups that follow a length: a block sends at most one group for each
    occurrence of a frequent phrase of that length."""
    most = level.agg(F.sum("a")).first()[0] or 0
    tasks = int(level.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # enough for all cores where there is work for them
    return max(1, -(-most // PART_GROUPS), min(tasks, 4 * most // PART_GROUPS))


def _numbered(df: DataFrame) -> DataFrame:
    """Frequent words, as they are written, with numbers without gaps."""
    held = C.materialize(df.withColumn("at", F.monotonically_increasing_id()), "phrase-groups")
    task, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(map(tuple, held.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()))
    ends = accumulate(n for _, n in sizes)
    begin = held.sparkSession.createDataFrame(pa.table({"task": pa.array([t for t, _ in sizes], pa.int64()),
                                                        "start": pa.array([end - n for (_, n), end in zip(sizes, ends)], pa.int64())}))
    return held.withColumn("task", task).join(F.broadcast(begin), "task").select("lang", "phrase", "a", (F.col("start") + place).alias("id"))


def _sub_phrase(first, size) -> F.Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def score_phrases(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, k, a, l, r, score`` of phrases of two words and more, by their
    lowest-scoring cut (the first of equals). ``score`` is floor(SCALE * a / (l + r))."""
    parts = phrases.select("lang", "phrase", "a")
    cuts = (phrases.where("k > 1")
            .select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .withColumns({"first": _sub_phrase(F.lit(1), F.col("cut")),
                          "rest": _sub_phrase(F.col("cut") + 1, F.col("k") - F.col("cut"))}))
    sided = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
             .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]))
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}BD) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    return (sided.withColumn("score", score).groupBy("lang", "phrase", "k", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
            .select("lang", "phrase", "k", "a", "best.l", "best.r", F.col("best.score").alias("score")))


def drop_covered(scored: DataFrame, phrases: DataFrame, cover: tuple[int, int] = COVER) -> DataFrame:
    """Without the phrases that stand inside a longer one, itself dropped or
    not, with ``cover[0] * f(longer) >= cover[1] * a``."""
    inner = (phrases.where("k > 2")
             .select("lang", "k", "phrase", F.col("a").alias("f"), F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
             .withColumn("first", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
             .select("lang", _sub_phrase(F.col("first"), F.col("size")).alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))
    wide = "DECIMAL(20,0)"
    covered = F.expr(f"CAST(longest AS {wide}) * {cover[0]} >= CAST(a AS {wide}) * {cover[1]}")
    return scored.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longest")


def mine_phrases(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases (see the module text)."""
    phrases, totals = frequent_phrases(docs, min_count, max_words, text_col, lang_col, block_bytes)
    left = drop_covered(score_phrases(phrases), phrases)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (ranked.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(C.table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '{NO_LANG}') AS lang,
                  translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS text FROM documents),
p AS (SELECT doc, lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
ws AS (SELECT row_number() OVER () AS pid, lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[s : s + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM ws, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= {MIN_COUNT}),
cut AS (SELECT lang, k, phrase, a, cut, array_to_string(ws[1 : cut], ' ') AS p1, array_to_string(ws[cut + 1 :], ' ') AS p2
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (SELECT cut.lang, cut.k, cut.phrase, cut.a, cut, x.a AS l, y.a AS r,
                  ({SCALE}::HUGEINT * cut.a) // (x.a + y.a) AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p1 JOIN f y ON y.lang = cut.lang AND y.phrase = p2),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, array_to_string(ws[s : s + z - 1], ' ') AS phrase, max(a) AS f
           FROM (SELECT *, unnest(range(1, k - z + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS z FROM c)) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inner_ USING (lang, phrase)
         WHERE inner_.f IS NULL OR {COVER[0]}::HUGEINT * inner_.f < {COVER[1]}::HUGEINT * best.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
