"""Jaccard join of documents on word shingles (operator 8).

A grouped prefix join. All shingles have one global order; two sets with
Jaccard 0.8 or more share one of their first ``n - ceil(0.8 n) + 1`` shingles,
their prefixes. Documents with equal sets are one class, and classes with
identical prefix and size one group; prefix shingles are indexed by group,
group pairs that share one are filtered by size, and their classes verified.

The order is by hash, with the most frequent shingles last, so that a passage
common to many documents is hardly ever in a prefix. Any order gives the same
result: the list of frequent shingles (of bounded length) decides costs only.

A shingle shared by m classes does not make m * m / 2 pairs. First every class
is verified against one pivot of its group, and every group against the pivot
groups with which it shares most shingles, one candidate per shingle. Then, per shingle, only classes of different components are
compared: all classes outside the shingle's largest component with the rest.
Pairs inside a component need no check, so no link that could change a
component is lost.

Each set has a bitmap in which every shingle flips one bit. The bitmaps of two
sets differ in at most as many bits as the sets differ in shingles, which gives
an upper bound of their overlap: pairs beyond it go before texts are compared.

Defined cases: null, empty and blank texts have no shingles and are linked
with nothing; rows with the same id share their component; a null id never is
a component's id, and its row has one if another row has the same shingles;
an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm import shingles as S
from adtrail.llm.graph import connected_components

PERCENT = 80
FREQUENT = 1_000_000  # length of the list of shingles ordered last (8 MB)
GROUP_PIVOTS = 8      # pivots a class is verified against in a round before step 2
ROUNDS = 3            # further such rounds against large components
LARGE = 32            # members of a component in one shingle
BLOCK_PAIRS = 256     # partners compared with one copy of a pivot's text
SLICE_REPEATS = 2     # a shingle counts as repeated in a slice from so many texts on
REPEAT_BYTES = 8 << 20  # text of such a slice; its shingles are one number a word
SEEN_SETS = 100_000   # set hashes a task remembers so as to send equal sets' prefix once

WORDS = 8             # 64-bit words of a set's bitmap
FOLDED = 4            # words of the folded bitmap that rows of step 2 carry

BITMAP = [f"s{i}" for i in range(WORDS)]
PREFIXES = ("doc_id long, n long, h1 long, h2 long, grp long, rare array<long>, common array<long>, "
            + ", ".join(f"{c} long" for c in BITMAP))


def repeated_shingles(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in C.slices([len(t) for t in texts], REPEAT_BYTES):
            once = list(dict.fromkeys(texts[a:b]))  # a copy adds nothing
            codes = [S.shingle_sets(once[i:j])[1] for i, j in C.slices([len(t) for t in once])]
            values, counts = np.unique(np.concatenate(codes), return_counts=True)
            often = counts >= SLICE_REPEATS
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["shingle", "n"])


def most_frequent(often: DataFrame, most: int) -> np.ndarray:
    """About ``most`` shingles (sorted) that occur most often. The counts alone say from
    which on they are listed, so no task sorts all of them; of those with that very count a share goes by hash.
    The driver gets one row a count and the list, as columns."""
    rows = often.groupBy("n").agg(F.count(F.lit(1)).alias("m")).toArrow()
    counts, held = (np.asarray(rows[c], np.int64) for c in ("n", "m"))
    order = np.argsort(-counts)
    total = np.cumsum(held[order])
    at = int(np.searchsorted(total, most, side="right"))
    if at == len(total):
        chosen = often
    else:
        last = order[at]
        room = most - int(total[at] - held[last])
        limit = -(1 << 63) + (room << 64) // int(held[last])
        chosen = often.where((F.col("n") > int(counts[last])) | (F.col("n") == int(counts[last])) & (F.col("shingle") < limit))
    return np.sort(np.asarray(chosen.select("shingle").toArrow()["shingle"], np.int64).view(np.uint64))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def prefixes(batches, frequent: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Sizes, set hashes and prefixes. Of equal sets a task remembers, only
    the first carries its prefix."""
    seen: set[int] = set()
    for batch in batches:
        docs, all_texts = batch.column(0), batch.column(1).to_pylist()
        for a, b in C.slices([len(t) for t in all_texts]):
            text, code, place = S.shingle_sets(all_texts[a:b], frequent)
            n = np.bincount(text, minlength=b - a).astype(np.int64)
            ends = np.cumsum(n)

            def total(x):
                run = np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])
                return run[ends] - run[ends - n]

            h1, h2 = total(S.mix(code)), total(S.mix(code * np.uint64(0xFF51AFD7ED558CCD)))
            _, first = np.unique(np.stack([h1, h2], axis=1), axis=0, return_index=True)
            carries = np.zeros(b - a, bool)
            carries[first] = True
            carries &= n > 0
            if len(seen) > SEEN_SETS:
                seen.clear()
            for i in np.flatnonzero(carries).tolist():
                name = int(h1[i]) << 64 | int(h2[i])
                if name in seen:
                    carries[i] = False
                seen.add(name)
            inside = place < prefix_length(n, percent)[text]
            grp = S.mix(total(np.where(inside, S.mix(code ^ np.uint64(0x2545F4914F6CDD1D)), np.uint64(0))) + n.astype(np.uint64))
            late = S.listed(code, frequent)
            bits = np.bincount(text * (64 * WORDS) + (code % np.uint64(64 * WORDS)).astype(np.int64), minlength=(b - a) * 64 * WORDS)
            bitmap = np.packbits((bits & 1).astype(bool).reshape(b - a, -1), axis=1).view(np.int64)
            lists = []
            for chosen in (inside & ~late & carries[text], inside & late & carries[text]):
                sizes = np.bincount(text[chosen], minlength=b - a)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(code[chosen].view(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [docs[a:b], pa.array(n), *(pa.array(x.view(np.int64)) for x in (h1, h2, grp)), *lists,
                 *(pa.array(bitmap[:, i], mask=~carries) for i in range(WORDS))],
                ["doc_id", "n", "h1", "h2", "grp", "rare", "common", *BITMAP])


def verify_blocks(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: the pivot's text of a block, then the texts to
    compare with it."""
    pivot, sets = None, []
    for batch in batches:
        pivots, blocks, others, classes, all_texts = (c.to_pylist() for c in batch.columns)
        links = []
        for a, b in C.slices([len(t) for t in all_texts]):
            text, code, _ = S.shingle_sets(all_texts[a:b])
            parts = np.split(code, np.cumsum(np.bincount(text, minlength=b - a))[:-1])
            for i, y in enumerate(parts, a):
                at = (pivots[i], blocks[i])
                if not others[i]:
                    if pivot != at:
                        pivot, sets = at, []
                    sets.append(y)  # more than one if rows share an id
                elif pivot == at:
                    for x in sets:
                        same = len(np.intersect1d(x, y, assume_unique=True))
                        if 100 * same >= percent * (len(x) + len(y) - same):
                            links.append((pivots[i], classes[i]))
                            break
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in links], pa.int64()) for i in (0, 1)], ["a", "b"])


def _sizes_fit(x, y, percent: int):
    return (F.least(x, y) * 100) >= (F.greatest(x, y) * percent)


def _overlap_possible(x: str, y: str, percent: int):
    """Two sets of sizes x and y that share k prefix shingles, the last at
    places i and j, have at most k + min(x - i, y - j) - 1 shingles in common:
    the others come after both places."""
    most = F.col("k") + F.least(F.col(x) - F.col("i"), F.col(y) - F.col("j")) - 1
    return most * (100 + percent) >= percent * (F.col(x) + F.col(y))


def _place_fits(x, y, i, j, percent: int):
    """Two sets that share the shingle at places i and j have at most
    min(i, j) shingles in common before it."""
    return (F.least(i, j) + F.least(x - i, y - j)) * (100 + percent) >= percent * (x + y)


def _bitmaps_fit(x, y, first: list[str], second: list[str], percent: int):
    """With d different bits the overlap is at most (x + y - d) / 2."""
    differ = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(q))) for p, q in zip(first, second)), F.lit(0))
    return (x + y - differ) * (100 + percent) >= 2 * percent * (x + y)


def _links(pairs: DataFrame, members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b: class ids) that reach the Jaccard threshold, verified on
    the texts of the classes in question."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def side(name: str) -> DataFrame:
        return members.select(F.col("cls").alias(name), F.col("n").alias(f"n{name}"), *[F.col(c).alias(f"{name}_{c}") for c in BITMAP])

    # rows that share an id may give a class id more than one set
    fit = _bitmaps_fit(F.col("na"), F.col("nb"), [f"a_{c}" for c in BITMAP], [f"b_{c}" for c in BITMAP], percent)
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(fit & _sizes_fit(F.col("na"), F.col("nb"), percent))
    pairs = C.materialize(pairs.select("a", "b").distinct(), "pairs")
    if pairs.isEmpty():
        return pairs
    # blocks of a pivot and some partners: a text is sent once a block, and no block grows with the data
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK_PAIRS).alias("blocks"))
    blocks = pairs.join(sizes, "a").select("a", "b", F.expr("int(pmod(xxhash64(b), blocks))").alias("block"))
    asked = blocks.select(F.col("a").alias("asked_id"), F.col("a").alias("pivot"), "block").distinct().unionByName(
        blocks.select(F.col("b").alias("asked_id"), F.col("a").alias("pivot"), "block"))
    asked = C.materialize(asked.groupBy("asked_id").agg(F.collect_list(F.struct("pivot", "block")).alias("asked")), "asked")
    ids = asked.select(F.col("asked_id").alias("doc_id"))
    wanted = (texts.join(C.small(ids, asked.count()), "doc_id", "left_semi")
              .join(asked, F.col("doc_id") == F.col("asked_id")))
    # texts compress well on their way; their sets, being hashes, do not
    rows = (wanted.select("doc_id", "text", F.explode("asked").alias("for"))
            .select("for.pivot", "for.block", (F.col("for.pivot") != F.col("doc_id")).alias("other"), F.col("doc_id").alias("cls"), "text"))
    dealt = rows.repartition("pivot", "block").sortWithinPartitions("pivot", "block", "other")
    return C.map_batches(dealt, verify_blocks, "a long, b long", percent=percent)


def jaccard_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    spark = docs.sparkSession
    texts = C.id_text(docs, id_col, text_col)
    often = C.materialize(C.map_batches(texts, repeated_shingles, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")), "repeated")
    frequent = most_frequent(often, FREQUENT)

    rows = C.materialize(C.map_batches(texts, prefixes, PREFIXES, frequent=frequent, percent=percent), "prefixes")
    members = C.materialize(rows.where("n > 0").groupBy("n", "h1", "h2", "grp").agg(
        F.min("doc_id").alias("cls"), *[F.min(c).alias(c) for c in BITMAP]), "classes")
    groups = members.groupBy("grp", "n").agg(F.min("cls").alias("pivot"))
    # the rows of one group carry the same prefix; a group met in several slices counts as often, which only costs rows
    prefix = rows.where("size(rare) + size(common) > 0")

    # 1. group pivots: rare shingles meet in a window, frequent ones by a pre-aggregated minimum
    place = F.struct("grp", "n", "pos")  # the pivot is a random group, as its name is a hash
    rare = prefix.select(F.posexplode("rare").alias("pos", "shingle"), "grp", "n")
    by_shingle = Window.partitionBy("shingle")
    rare = (rare.withColumn("met", F.count(F.lit(1)).over(by_shingle)).withColumn("first", F.min(place).over(by_shingle))
            .where("met > 1").drop("met"))
    common = (prefix.select(F.posexplode("common").alias("at", "shingle"), "grp", "n", F.size("rare").alias("before"))
              .select((F.col("at") + F.col("before")).alias("pos"), "shingle", "grp", "n"))
    firsts = common.groupBy("shingle").agg(F.count(F.lit(1)).alias("met"), F.min(place).alias("first")).where("met > 1").drop("met")
    met = C.materialize(rare.unionByName(common.join(firsts, "shingle")), "met")

    to_pivot = (met.where((F.col("grp") != F.col("first.grp")) & _sizes_fit(F.col("n"), F.col("first.n"), percent)
                          & _place_fits(F.col("n"), F.col("first.n"), F.col("pos"), F.col("first.pos"), percent))
                .groupBy("grp", "n", F.col("first.grp").alias("grp2"), F.col("first.n").alias("n2"))
                .agg(F.count(F.lit(1)).alias("k"))
                # of a group's pivots those that share most; the rest is left to step 2
                .withColumn("rank", F.row_number().over(Window.partitionBy("grp", "n").orderBy(F.desc("k"), "grp2", "n2")))
                .where(F.col("rank") <= GROUP_PIVOTS).select("grp", "n", "grp2", "n2"))
    pivot2 = groups.select(F.col("grp").alias("grp2"), F.col("n").alias("n2"), F.col("pivot").alias("b"))
    pairs = (members.join(groups, ["grp", "n"]).select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
             .unionByName(to_pivot.join(groups, ["grp", "n"]).join(pivot2, ["grp2", "n2"]).select(F.col("pivot").alias("a"), "b")))
    links = C.materialize(_links(pairs, members, texts, percent), "links")
    found = connected_components(links)

    def joined(found: DataFrame, new: DataFrame) -> DataFrame:
        """Components after new links: the known ones come as stars."""
        stars = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        return connected_components(stars.unionByName(new))

    short = [f"f{i}" for i in range(FOLDED)]
    folded = [F.col(BITMAP[i]).bitwiseXOR(F.col(BITMAP[i + FOLDED])).alias(c) for i, c in enumerate(short)]

    def open_places(found: DataFrame) -> DataFrame:
        """Per shingle (and per group), the classes where these are of
        different components, with the largest component there."""
        known = members.join(found, members["cls"] == found["node"], "left").select(
            "grp", "n", "cls", F.coalesce("component", "cls").alias("component"), *folded)
        known = C.materialize(known, "known")
        inside = known.groupBy("grp", "n").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        shared = (met.select("shingle", "grp", "n", "pos").distinct()
                  .unionByName(inside.select(F.col("grp").alias("shingle"), "grp", "n", F.lit(-1).alias("pos")))
                  .join(known, ["grp", "n"]).select("shingle", "cls", "n", "component", "pos", *short))
        sizes = shared.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("m"))
        largest = sizes.groupBy("shingle").agg(F.max(F.struct("m", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        return C.materialize(shared.join(largest.select("shingle", F.col("top.component").alias("main"), F.col("top.m").alias("main_size")),
                                         "shingle"), "open")

    open_rows = open_places(found)
    for turn in range(ROUNDS):
        # classes beside a large component: against other random members of it
        large = open_rows.where(F.col("main_size") >= LARGE)
        pivots = large.where("component = main").groupBy("shingle").agg(
            F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), "cls", "n")).alias("p"))
        beside = (large.where("component <> main").join(pivots, "shingle").where(_sizes_fit(F.col("n"), F.col("p.n"), percent))
                  .groupBy(F.col("cls").alias("a"), F.col("p.cls").alias("b")).agg(F.count(F.lit(1)).alias("k"))
                  .withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("k"), "b")))
                  .where(F.col("rank") <= GROUP_PIVOTS).select("a", "b"))
        new = C.materialize(_links(beside, members, texts, percent), "links")
        if new.isEmpty():
            break
        found = joined(found, new)
        open_rows = open_places(found)

    # 2. classes of different components
    outside = open_rows.where("component <> main").select("shingle", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("pos").alias("pa"),
                                                           *[F.col(c).alias(f"a_{c}") for c in short])
    others = open_rows.select("shingle", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("pos").alias("pb"), "main",
                              *[F.col(c).alias(f"b_{c}") for c in short])
    # two rows outside the largest component meet once, not twice
    rest = (outside.join(others, "shingle")
            .where((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b")))
                   & _sizes_fit(F.col("na"), F.col("nb"), percent)
                   & ((F.col("pa") < 0) | _place_fits(F.col("na"), F.col("nb"), F.col("pa"), F.col("pb"), percent))
                   & _bitmaps_fit(F.col("na"), F.col("nb"), [f"a_{c}" for c in short], [f"b_{c}" for c in short], percent))
            # the same pair may come either way round from two shingles
            .select(*[F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in
                      (("a", "b"), ("b", "a"), ("na", "nb"), ("nb", "na"), ("pa", "pb"), ("pb", "pa"))])
            .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("k"), F.max("pa").alias("i"), F.max("pb").alias("j"),
                                               F.min("pa").alias("least"))
            .where((F.col("least") < 0) | _overlap_possible("na", "nb", percent)).select("a", "b"))
    more = C.materialize(_links(rest, members, texts, percent), "links")
    final = joined(found, more)

    labelled = members.join(final, members["cls"] == final["node"], "left").select(
        "n", "h1", "h2", F.coalesce("component", "cls").alias("component_id"))
    return (rows.select("doc_id", "n", "h1", "h2").join(labelled, ["n", "h1", "h2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(C.table(spark, sf_dir, "documents"))


# Distinct shingles of each document; pairs are counted through shared shingles.
OP8_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 5], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 5, 0) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (WITH RECURSIVE r(doc_id, c) AS (SELECT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
      SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r.c, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)
"""
