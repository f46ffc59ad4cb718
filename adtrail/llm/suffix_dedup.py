"""Exact substring deduplication by suffix arrays (operator 2).

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere is
removed. A corpus-wide suffix array would have to compare every shard with
every other; instead equal strings are brought into the same shard first.

1. Each ``LENGTH``-byte window is assigned to the ``GRAM``-byte gram with the
   least hash inside it (the leftmost of equals). Equal windows have the same
   gram at the same place, and consecutive windows mostly share one, so a text
   falls into runs of windows, one row each, about one per 140 bytes.
2. Runs whose gram occurs once have no duplicate window. Runs of equal content
   (all copies of a text) are one segment with a count. If all runs of a gram
   are equal, all their windows are duplicates.
3. The distinct segments of the other grams are dealt by gram and cut into
   shards. Each shard gets a suffix array (Larsson-Sadakane refinement) and
   common prefixes (Kasai); suffixes with common prefixes of ``LENGTH`` bytes
   form groups of equal windows. A gram with segments in several shards has
   them merged by binary search of each shard's windows in the others' suffix
   arrays.
4. A gram with more than ``SHARD_SEGMENTS`` distinct segments (a passage in a
   large part of all documents) would grow with the data, so its windows are
   counted by 128-bit hashes instead, pre-aggregated where they are read.

Equality of grams, segments and hot windows rests on 128 bits of hashes.
Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose
nothing; rows equal in id and text are duplicates of each other, as are rows
with a null id; an empty table gives no rows; columns other than id and text
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm import shingles as S

LENGTH = 400
GRAM = 128
SHARD_SEGMENTS = 1024          # distinct segments of a gram that suffix arrays handle
SHARD_BYTES = 1 << 20
SLICE_BYTES = 2 << 20
CHUNK_BYTES = 8 << 20          # longer texts are cut into overlapping chunks
_PLACE_BITS = 24               # a place within a chunk

RUNS = "rid long, start int, windows int, gram long, content long, repeats int, step int"


def prefix_sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial sums of the bytes, and the inverse powers."""
    powers, inverses = S._tables(len(buf) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers[:len(buf)], dtype=np.uint64)])
    return sums, inverses


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive numbers."""
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def window_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows of the texts ``buf[starts:ends]``: text number, first
    window (in ``buf``), number of windows, gram hash, content hash."""
    sums, inverses = prefix_sums(buf)
    k = len(buf) - gram + 1
    grams = S.mix((sums[gram:gram + k] - sums[:k]) * inverses[:k])
    place = np.arange(k, dtype=np.uint64)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    least = sliding_min((grams & ~mask) | place, length - gram + 1)
    text = np.repeat(np.arange(len(starts)), ends - starts)[:len(least)]
    valid = np.arange(len(least)) + length <= ends[text]
    anchor = (least & mask).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]]) & valid
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]]))
    content = S.mix((sums[last + length] - sums[first]) * inverses[first] + (last - first).astype(np.uint64))
    return text[first], first, last - first + 1, grams[anchor[first]], content


def stretches(text: np.ndarray, first: np.ndarray, grams: np.ndarray, content: np.ndarray):
    """A periodic text repeats a run at a constant step: the first run of each
    such stretch, how often it stands, and the step."""
    n = len(first)
    same = np.zeros(n, bool)
    same[1:] = (text[1:] == text[:-1]) & (grams[1:] == grams[:-1]) & (content[1:] == content[:-1])
    gap = np.diff(first, prepend=0)
    joined = same.copy()
    joined[1:] &= ~same[:-1] | (gap[1:] == gap[:-1])
    lead = np.flatnonzero(~joined)
    repeats = np.diff(np.append(lead, n))
    step = np.where(repeats > 1, gap[np.minimum(lead + 1, n - 1)] if n else 0, 0)
    return lead, repeats, step


def _chunks(data: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text number, offset, bytes) of bounded size. Chunks of one
    text overlap by one window less a byte."""
    out, size = [], 0
    for i, d in enumerate(data):
        for at in range(0, max(1, len(d) - length + 1), CHUNK_BYTES):
            part = d[at:at + CHUNK_BYTES + length - 1]
            if len(part) < length:
                continue
            if out and size + len(part) > SLICE_BYTES:
                yield out
                out, size = [], 0
            out.append((i, at, part))
            size += len(part)
    if out:
        yield out


def find_runs(batches, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for a, b in C.slices([len(t) for t in texts], 2 * SLICE_BYTES):
            for part in _chunks([t.encode() for t in texts[a:b]], length):
                buf = np.frombuffer(b"".join(p for _, _, p in part), np.uint8)
                ends = np.cumsum([len(p) for _, _, p in part])
                starts = ends - [len(p) for _, _, p in part]
                text, first, windows, grams, content = window_runs(buf, starts, ends, length, gram)
                number = np.array([i for i, _, _ in part])
                offset = np.array([o for _, o, _ in part])
                lead, repeats, step = stretches(text, first, grams, content)
                text, first = text[lead], first[lead]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids[a + number[text]]), pa.array((first - starts[text] + offset[text]).astype(np.int32)),
                     pa.array(windows[lead].astype(np.int32)), pa.array(grams[lead].view(np.int64)),
                     pa.array(content[lead].view(np.int64)), pa.array(repeats.astype(np.int32)), pa.array(step.astype(np.int32))],
                    [x.split()[0] for x in RUNS.split(", ")])


def words8(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as big-endian numbers."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(buf)].copy().view(">u8")[:, 0].astype(np.uint64)


def suffix_array(buf: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` bytes at least, by
    Larsson-Sadakane refinement: groups of suffixes equal in their first h
    bytes are sorted by the groups of the suffixes h bytes on, which doubles
    h; groups of one are left alone."""
    n = len(buf)
    key = words8(buf)
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]  # a group's number is the place of its first suffix
    h = 8
    single = head & np.concatenate([head[1:], [True]])
    todo = np.flatnonzero(~single)
    while len(todo) and h < depth:
        sa = order[todo]
        group = rank[sa]
        follow = rank[np.minimum(sa + h, n)]
        by = np.argsort((group << 32) | (follow + 1), kind="stable")
        sa, group, follow = sa[by], group[by], follow[by]
        order[todo] = sa
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        number = todo[np.flatnonzero(new)][np.cumsum(new) - 1]
        rank[sa] = number
        lone = new & np.concatenate([new[1:], [True]])
        todo = todo[~lone]
        h *= 2
    return order


def common_prefixes(buf: np.ndarray, order: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """Kasai: length (up to ``limit``) of the common prefix of every suffix
    with its predecessor in the order. A place keeps all but one byte of its
    left neighbour's prefix; all segments advance in step."""
    n = len(buf)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    word = np.concatenate([words8(buf), np.zeros(limit + 16, np.uint64)])
    byte = np.concatenate([buf, np.zeros(limit + 16, np.uint8)])
    out = np.zeros(n, np.int32)
    by_length = np.argsort(starts - ends, kind="stable")  # longest first: those still going are a prefix
    starts, lengths = starts[by_length], (ends - starts)[by_length]
    have = np.zeros(len(starts), np.int64)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        going = int(np.searchsorted(-lengths, -step, side="left"))
        at = starts[:going] + step
        other = before[at]
        h = np.maximum(have[:going] - 1, 0)
        h[other < 0] = 0
        active = np.flatnonzero((other >= 0) & (h < limit))
        while len(active):
            x, y = at[active] + h[active], other[active] + h[active]
            same = word[x] == word[y]
            h[active[same]] += 8
            rest = active[~same]
            if len(rest):  # the first differing byte of eight
                diff = word[at[rest] + h[rest]] ^ word[other[rest] + h[rest]]
                h[rest] += _equal_bytes(diff)
            active = active[same]
            active = active[h[active] < limit]
        h = np.minimum(h, limit)
        have[:going] = h
        out[at] = h
    del byte
    return out


def _equal_bytes(diff: np.ndarray) -> np.ndarray:
    """Leading zero bytes of non-zero numbers."""
    out = np.zeros(len(diff), np.int64)
    for k in range(1, 8):
        out += diff < (np.uint64(1) << np.uint64(64 - 8 * k))
    return out


class Shard:
    """Suffix array of some segments and the groups of equal windows."""

    def __init__(self, segments: list[bytes], windows: np.ndarray, counts: np.ndarray, length: int):
        self.length = length
        self.buf = np.frombuffer(b"".join(segments), np.uint8)
        sizes = np.array([len(s) for s in segments])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        order = suffix_array(self.buf, length)
        shared = common_prefixes(self.buf, order, self.starts, self.ends, length)
        segment = np.repeat(np.arange(len(segments)), sizes)
        offset = np.arange(len(self.buf)) - self.starts[segment]
        is_window = offset < windows[segment]
        group = np.cumsum(shared[order] < length) - 1
        weight = np.where(is_window, counts[segment], 0)[order]
        total = np.bincount(group, weight)
        self.repeated = np.zeros(len(self.buf), bool)  # windows that occur twice or more
        self.repeated[order] = (total[group] > 1) & is_window[order]
        # one window of every group, in sorted order, with the group's members
        mine = is_window[order]
        self.sorted_windows = order[mine]
        self.window_group = group[mine]
        lead = np.concatenate([[True], self.window_group[1:] != self.window_group[:-1]]) if mine.any() else np.zeros(0, bool)
        self.leads = self.sorted_windows[lead]
        self.word = words8(self.buf)

    def compare(self, mine: np.ndarray, other: Shard, theirs: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for pairs of windows."""
        out = np.zeros(len(mine), np.int8)
        active = np.arange(len(mine))
        for at in range(0, self.length, 8):
            step = min(at, self.length - 8)  # the last eight bytes may overlap
            x, y = self.word[mine[active] + step], other.word[theirs[active] + step]
            out[active[x < y]], out[active[x > y]] = -1, 1
            active = active[x == y]
            if not len(active):
                break
        return out

    def merge(self, other: Shard) -> None:
        """Mark the windows that both shards have, by binary search of this
        shard's distinct windows in the other's."""
        if not len(self.leads) or not len(other.leads):
            return
        low = np.zeros(len(self.leads), np.int64)
        high = np.full(len(self.leads), len(other.leads), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            less = other.compare(other.leads[mid], self, self.leads[open_]) < 0
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
        inside = np.flatnonzero(low < len(other.leads))
        equal = inside[self.compare(self.leads[inside], other, other.leads[low[inside]]) == 0]
        for shard, groups in ((self, np.unique(self.window_group[np.isin(self.sorted_windows, self.leads[equal])])),
                              (other, np.unique(other.window_group[np.isin(other.sorted_windows, other.leads[low[equal]])]))):
            shard.repeated[shard.sorted_windows[np.isin(shard.window_group, groups)]] = True

    def intervals(self) -> list[list[dict]]:
        """Per segment the runs (first, last) of repeated windows."""
        out = []
        for a, b in zip(self.starts.tolist(), self.ends.tolist()):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], self.repeated[a:b].astype(np.int8), [0]])))
            out.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(edge[0::2], edge[1::2])])
        return out


def repeated_windows(batches, length: int) -> Iterator[pa.RecordBatch]:
    """``gram, content, found`` of segments that come sorted by gram."""
    held: list[tuple] = []
    size = 0

    def solve(rows):
        shards, at, cut = [], 0, 0
        for i, r in enumerate(rows):
            cut += len(r[4])
            if cut >= SHARD_BYTES or i == len(rows) - 1:
                part = rows[at:i + 1]
                shards.append(Shard([p[4] for p in part], np.array([p[3] for p in part]), np.array([p[2] for p in part]), length))
                at, cut = i + 1, 0
        for i, a in enumerate(shards):
            for b in shards[i + 1:]:
                a.merge(b)
        found = [x for s in shards for x in s.intervals()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array(found, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))], ["gram", "content", "found"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != held[-1][0] and size + len(row[4]) > SHARD_BYTES:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield solve(held)


def cut_segments(batches, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, contents, counts, windows, parts = [], [], [], [], []
        for text, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode()
            for x in asked:
                grams.append(x["gram"])
                contents.append(x["content"])
                counts.append(x["copies"])
                windows.append(x["windows"])
                parts.append(data[x["start"]:x["start"] + x["windows"] + length - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.int64()), pa.array(contents, pa.int64()), pa.array(counts, pa.int64()),
             pa.array(windows, pa.int32()), pa.array(parts, pa.binary())], ["gram", "content", "copies", "windows", "bytes"])


def hash_windows(batches, length: int) -> Iterator[pa.RecordBatch]:
    """``gram, content, place, copies, w1, w2`` of each window of a segment."""
    for batch in batches:
        grams, contents, counts, windows, parts = (c.to_pylist() for c in batch.columns)
        for a, b in C.slices([len(p) for p in parts], SLICE_BYTES // 8):
            buf = np.frombuffer(b"".join(parts[a:b]), np.uint8)
            sums, inverses = prefix_sums(buf)
            sizes = np.array([len(p) for p in parts[a:b]])
            n = np.array(windows[a:b])
            segment = np.repeat(np.arange(b - a), n)
            place = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(sizes) - sizes)[segment] + place
            half = length // 2
            w1 = S.mix((sums[at + half] - sums[at]) * inverses[at])
            w2 = S.mix((sums[at + length] - sums[at + half]) * inverses[at + half])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(grams[a:b], np.int64)[segment]), pa.array(np.array(contents[a:b], np.int64)[segment]),
                 pa.array(place.astype(np.int32)), pa.array(np.array(counts[a:b], np.int64)[segment]),
                 pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64))],
                ["gram", "content", "place", "copies", "w1", "w2"])


def cut_out(batches) -> Iterator[pa.RecordBatch]:
    """Sizes and checksums of the texts without the spans."""
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            digest, at, n_spans, removed = hashlib.sha256(), 0, 0, 0
            reached = -1
            for s in sorted((x["start"], x["end"]) for x in spans or ()):
                if s[0] > reached:
                    if reached >= 0:
                        removed += reached - begun
                        at = reached
                    digest.update(data[at:s[0]])
                    begun, n_spans = s[0], n_spans + 1
                    reached = s[1]
                else:
                    reached = max(reached, s[1])
            if n_spans:
                removed += reached - begun
                at = reached
            digest.update(data[at:])
            rows.append((doc, len(data), removed, n_spans, digest.hexdigest()))
        types = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """``rid, spans`` (start, end in bytes; they may overlap). ``texts``:
    rid, text."""
    runs = C.materialize(C.map_batches(texts, find_runs, RUNS, length=length, gram=gram), "runs")
    grams = runs.groupBy("gram").agg(F.sum("repeats").alias("n")).where("n > 1").select("gram")
    runs = C.materialize(runs.join(grams, "gram", "left_semi"), "met-runs")
    segments = runs.groupBy("gram", "content", "windows").agg(
        F.sum("repeats").alias("copies"), F.min(F.struct("rid", "start")).alias("at"))
    kinds = segments.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    segments = C.materialize(segments.join(kinds, "gram"), "segments")

    whole = (segments.where("copies > 1").select("gram", "content", F.lit(0).alias("first"), (F.col("windows") - 1).alias("last")))
    mixed = segments.where("kinds > 1")
    asked = C.materialize(mixed.groupBy(F.col("at.rid").alias("asked_id")).agg(F.collect_list(
        F.struct("gram", "content", "copies", "windows", F.col("at.start").alias("start"), "kinds")).alias("asked")), "asked")
    ids = asked.select(F.col("asked_id").alias("rid"))
    asked_texts = (texts.join(C.small(ids, asked.count()), "rid", "left_semi").dropDuplicates(["rid"])
                   .join(asked, F.col("rid") == F.col("asked_id")).select("text", "asked"))
    pieces = C.materialize(C.map_batches(asked_texts, cut_segments, "gram long, content long, copies long, windows int, bytes binary",
                                         length=length).join(kinds_of(segments, shard_segments), "gram", "left")
                           .withColumn("hot", F.coalesce("hot", F.lit(False))), "pieces")
    columns = ["gram", "content", "copies", "windows", "bytes"]
    few = pieces.where("NOT hot").select(columns).repartition("gram").sortWithinPartitions("gram", "content")
    by_arrays = (C.map_batches(few, repeated_windows, "gram long, content long, found array<struct<first:int,last:int>>", length=length)
                 .select("gram", "content", F.inline("found")))
    many = C.map_batches(pieces.where("hot").select(columns), hash_windows,
                         "gram long, content long, place int, copies long, w1 long, w2 long", length=length)
    twice = many.groupBy("w1", "w2").agg(F.sum("copies").alias("total")).where("total > 1").select("w1", "w2")
    by_hash = (many.join(twice, ["w1", "w2"], "left_semi").select("gram", "content", F.col("place").alias("first"), F.col("place").alias("last")))

    found = whole.unionByName(by_arrays).unionByName(by_hash)
    at = F.explode(F.transform(F.sequence(F.lit(0), F.col("repeats") - 1), lambda i: F.col("start") + i * F.col("step")))
    spans = (runs.join(found, ["gram", "content"]).where("last < windows").select("rid", "first", "last", at.alias("at"))
             .select("rid", F.struct((F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + length).alias("end")).alias("span")))
    return spans.groupBy("rid").agg(F.collect_list("span").alias("spans"))


def kinds_of(segments: DataFrame, shard_segments: int) -> DataFrame:
    """Grams with more distinct segments than suffix arrays handle."""
    return segments.where(F.col("kinds") > shard_segments).select("gram").distinct().withColumn("hot", F.lit(True))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    # rows equal in id and text share a key: what is repeated in one is in the other
    texts = C.id_text(docs, id_col, text_col).withColumn("rid", F.xxhash64("doc_id", "text"))
    spans = C.materialize(repeated_spans(texts.select("rid", "text"), length, gram, shard_segments), "spans")
    joined = texts.join(spans.withColumnRenamed("rid", "span_id"), F.col("rid") == F.col("span_id"), "left").select("doc_id", "text", "spans")
    return C.map_batches(joined, cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(C.table(spark, sf_dir, "documents"))


# Windows by place and digest; what remains is put together as hexadecimal.
OP2_SQL = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) AS m
      FROM (SELECT doc_id, h, unnest(range(0, n - {LENGTH} + 1)) AS i FROM d)),
r AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM w SEMI JOIN r ON w.m = r.m),
g AS (SELECT doc_id, i, sum(CASE WHEN prev IS NULL OR i > prev + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM p),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + {LENGTH} AS e FROM g GROUP BY doc_id, k),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS h
         FROM (SELECT d.doc_id, h, coalesce(lag(e) OVER (PARTITION BY s.doc_id ORDER BY a), 0) AS before, a FROM s JOIN d USING (doc_id)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_spans, sum(e - a) AS n_removed, max(e) AS e FROM s GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN t.doc_id IS NULL THEN d.h ELSE kept.h || substr(d.h, 2 * t.e + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
