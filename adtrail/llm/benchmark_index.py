"""Benchmark decontamination by a positional inverted index (operator 9).

The words of the training documents that occur in the benchmark are stored as
postings (term, document, position). A benchmark window is looked up from its
rarest terms: their posting lists, moved back by each term's place in the
window, are intersected, and what remains is compared word by word with the
document. Proximity search intersects the same postings within a slop.

Only DataFrame functions are used. Defined cases: a null text has no words; an
item without words has no window; a null or repeated document id is judged
row by row; empty tables give no hits (or no rows); columns other than id and
text are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.llm import common as C

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
ANCHORS = 2  # posting lists intersected per window


def words(text: Column) -> Column:
    """Lower-cased words; a text without words gives one empty word, and a
    separator at the end a last empty word."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.split(F.regexp_replace(low, "^" + SEPARATOR, ""), SEPARATOR)


def word_count(ws: Column) -> Column:
    return F.size(ws) - F.when(F.element_at(ws, -1) == "", 1).otherwise(0)


def benchmark_windows(bench: DataFrame, window_words: int = WINDOW_WORDS,
                      id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, phrase, n``: all runs of ``window_words`` words of an item;
    a shorter item is one window."""
    ws = words(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    items = (bench.select(F.col(f"`{id_col}`").alias("item_id"), ws.alias("ws"))
             .select("item_id", "ws", word_count(F.col("ws")).alias("size")).where("size > 0"))
    starts = F.sequence(F.lit(0), F.greatest(F.col("size") - window_words, F.lit(0)))
    return (items.select("item_id", "ws", "size", F.explode(starts).alias("s"))
            .select("item_id", F.array_join(F.slice("ws", F.col("s") + 1, F.least("size", F.lit(window_words))), " ").alias("phrase"),
                    F.least("size", F.lit(window_words)).alias("n")).distinct())


def build_postings(docs: DataFrame, vocabulary: DataFrame, rows: int) -> DataFrame:
    """``term_id, doc_id, pos`` of every vocabulary word of every document,
    stored in the shared folder. ``docs``: doc_id (each row has its own), text."""
    exploded = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return C.materialize(exploded.join(C.small(vocabulary, rows), "term").select("term_id", "doc_id", "pos"), "postings")


def phrase_candidates(postings: DataFrame, terms: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """``doc_id, start, window``: places where the rarest terms of a window
    stand at its offsets. ``terms``: window, offset, term_id (one row per word
    of a window). A window with a word no document has is dropped."""
    df = postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    by_window = Window.partitionBy("window")
    ranked = (terms.join(df, "term_id", "left")
              .withColumn("absent", F.max(F.col("df").isNull()).over(by_window)).where(~F.col("absent"))
              .withColumn("rank", F.row_number().over(by_window.orderBy("df", "offset")))
              .withColumn("lists", F.least(F.count(F.lit(1)).over(by_window), F.lit(anchors)))
              .where(F.col("rank") <= anchors).select("window", "offset", "term_id", "lists"))
    chosen = C.materialize(ranked, "anchors")
    moved = (postings.join(C.small(chosen, chosen.count()), "term_id")
             .select("doc_id", (F.col("pos") - F.col("offset")).alias("start"), "window", "lists").where("start >= 0"))
    return (moved.groupBy("doc_id", "start", "window", "lists").agg(F.count(F.lit(1)).alias("found"))
            .where("found = lists").select("doc_id", "start", "window"))


def proximity_matches(postings: DataFrame, first_term: int, second_term: int, slop: int) -> DataFrame:
    """``doc_id, pos, pos2``: the nearest later place of the second term at
    most ``slop`` words after each place of the first."""
    both = postings.where(F.col("term_id").isin(first_term, second_term))
    later = Window.partitionBy("doc_id").orderBy("pos", F.col("term_id") != first_term).rowsBetween(1, Window.unboundedFollowing)
    near = both.withColumn("pos2", F.first(F.when(F.col("term_id") == second_term, F.col("pos")), ignorenulls=True).over(later))
    return (near.where((F.col("term_id") == first_term) & (F.col("pos2") - F.col("pos") <= slop))
            .select("doc_id", "pos", "pos2"))


def decontaminate(docs: DataFrame, bench: DataFrame, window_words: int = WINDOW_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, item_ids,
    contaminated`` and ``spans`` (start and length of each occurrence)."""
    # ids may be null or repeat, so postings go by a number of the row
    base = C.materialize(C.id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "rows")
    windows = C.materialize(benchmark_windows(bench, window_words, item_col, item_text_col), "windows")
    phrases = C.materialize(windows.groupBy("phrase").agg(F.max("n").alias("n"))
                            .withColumn("window", F.monotonically_increasing_id()), "phrases")
    split_terms = phrases.select("window", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    vocabulary = C.materialize(split_terms.select("term").distinct()
                               .withColumn("term_id", F.monotonically_increasing_id().cast("long")), "vocabulary")
    n_terms, n_phrases = vocabulary.count(), phrases.count()
    postings = build_postings(base.select(F.col("row").alias("doc_id"), "text"), vocabulary, n_terms)
    terms = split_terms.join(vocabulary, "term").select("window", "offset", "term_id")
    found = (phrase_candidates(postings, terms).join(C.small(phrases, n_phrases), "window")
             .groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "window", "phrase")).alias("found"))
             .withColumnRenamed("doc_id", "row"))
    found = C.materialize(found, "found")

    # only texts with a place to compare are sent
    asked = base.join(C.small(found.select("row"), found.count()), "row", "left_semi")
    checked = asked.join(found, "row").select("row", words(F.col("text")).alias("ws"), "found")
    same = F.filter("found", lambda x: F.array_join(F.slice("ws", x["start"] + 1, x["n"]), " ") == x["phrase"])
    hits = C.materialize(checked.select(
        "row", F.transform(same, lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["n"]).alias("end"),
                                                    x["window"].alias("window"))).alias("hits")), "hits")

    occurrences = hits.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    by_row = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = occurrences.select("row", "start", "end").distinct()
    covered = (spans.withColumn("reached", F.coalesce(F.max("end").over(by_row), F.lit(0)))
               .groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).alias("n_hit"),
                                   F.array_sort(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("length")))).alias("spans")))
    window_items = phrases.join(windows, "phrase").select("window", "item_id")
    items = (occurrences.select("row", "window").distinct().join(window_items, "window")
             .select("row", F.col("item_id").cast("string").alias("item_id")).distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids")))
    judged = base.select("row", "doc_id", word_count(words(F.col("text"))).cast("long").alias("n_words"))
    return (judged.join(covered, "row", "left").join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans")))


def op9_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


_SPLIT = (f"list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', "
          f"'{string.ascii_lowercase}'), '{SEPARATOR}'), lambda x: x <> '')")
OP9_SQL = f"""
WITH w AS (SELECT doc_id, {_SPLIT} AS ws FROM documents),
i AS (SELECT item_id, {_SPLIT} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW_WORDS}) AS n, array_to_string(ws[s + 1 : s + {WINDOW_WORDS}], ' ') AS p
        FROM (SELECT item_id, ws, unnest(range(0, greatest(len(ws) - {WINDOW_WORDS}, 0) + 1)) AS s FROM i WHERE len(ws) > 0)),
d AS (SELECT doc_id, n, s, array_to_string(ws[s + 1 : s + n], ' ') AS p
      FROM (SELECT doc_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS s FROM w, (SELECT DISTINCT n FROM win))),
hit AS (SELECT d.doc_id, d.s, d.n, win.item_id FROM d JOIN win ON d.p = win.p AND d.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
