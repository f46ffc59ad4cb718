"""License scan by ordered signature rules (operator 1).

A keyword prefilter picks the documents and rules worth matching; the rules'
regular expressions run over the text written as ``<word><word>...``. A
detection whose words lie inside those of a detection with a better or equal
priority is suppressed. Base phrases are counted before suppression and keep
their labels.

Only DataFrame functions are used. Defined cases: a null or empty text has no
words and no detection; null or repeated ids are scanned row by row; of equal
detections the rule that stands first wins; an empty table gives no rows;
columns other than id and text are ignored.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm.license_rules import BASE, Rule, all_rules, compile_pattern, stem

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = (1, 2, 3, 4)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """One row per rule. The size is that of the rule list, whatever the data."""
    rows = [F.struct(F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                     F.lit(r.confidence).alias("confidence"), F.lit(r.keyword).alias("keyword"),
                     F.lit(compile_pattern(r.pattern)).alias("regex"), F.lit(r.base).alias("base"))
            for i, r in enumerate(rules)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def word_texts(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``row, doc_id, n_words, marked``: the text as ``<word>...``, null where
    no rule can match."""
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    gate = reduce(or_, [F.contains("low", F.lit(s)) for s in sorted({stem(r) for r in rules})])
    out = (docs.select("doc_id", low.alias("low"))
           .select("doc_id", gate.alias("gate"), F.split("low", SEPARATOR).alias("ws"))
           .select("doc_id", "gate", "ws",
                   (F.size("ws") - (F.element_at("ws", 1) == "").cast("int") - (F.element_at("ws", -1) == "").cast("int")).alias("n")))
    marked = F.concat(F.lit("<"), F.array_join(F.array_remove("ws", ""), "><"), F.lit(">"))
    return C.materialize(out.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                    F.greatest("n", F.lit(0)).cast("long").alias("n_words"),
                                    F.when(F.col("gate"), marked).alias("marked")), "license-words")


def detect(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``row, rule, label, priority, confidence, base, start, end`` of every
    match of every gated rule, in words."""
    table = rule_table(texts.sparkSession, rules)
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])
    hit = (texts.where("marked IS NOT NULL")
           .select("row", "marked", F.translate("marked", "<>", " ").alias("flat"))
           .select("row", "marked", F.explode(F.filter(keywords, lambda k: F.contains(F.col("flat"), k))).alias("keyword")))
    pieces = (hit.join(F.broadcast(table), "keyword")
              .select("row", "rule", "label", "priority", "confidence", "base",
                      F.expr("regexp_extract_all(marked, regex, 0)").alias("matched"),
                      F.expr("split(marked, regex, -1)").alias("before"))
              .where(F.size("matched") > 0)
              .select("row", "rule", "label", "priority", "confidence", "base",
                      F.posexplode(F.arrays_zip("before", "matched")).alias("i", "z"))
              .where("z.matched IS NOT NULL"))

    def n_words(c):
        return F.length(c) - F.length(F.replace(c, F.lit("<")))

    counted = pieces.select("row", "rule", "label", "priority", "confidence", "base", "i",
                            n_words(F.col("z.before")).alias("skipped"), n_words(F.col("z.matched")).alias("size"))
    so_far = Window.partitionBy("row", "rule").orderBy("i")
    return (counted.withColumn("end", F.sum(F.col("skipped") + F.col("size")).over(so_far))
            .withColumn("start", F.col("end") - F.col("size"))
            .select("row", "rule", "label", "priority", "confidence", "base", "start", "end"))


def suppress(detections: DataFrame) -> DataFrame:
    """Without detections inside one of better or equal priority. Sorted by
    start and descending end, a container always comes first, so a running
    largest end per priority finds it."""
    before = (Window.partitionBy("row").orderBy("start", F.desc("end"), "priority", "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    reached = {p: F.max(F.when(F.col("priority") <= p, F.col("end"))).over(before) for p in PRIORITIES}
    out = detections
    for p in PRIORITIES:
        out = out.withColumn(f"reached{p}", reached[p])
    mine = F.coalesce(*[F.when(F.col("priority") == p, F.col(f"reached{p}")) for p in PRIORITIES], F.lit(0))
    return out.where(mine < F.col("end")).drop(*[f"reached{p}" for p in PRIORITIES])


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score`` and the surviving ``detections``."""
    rules = rules or all_rules()
    texts = word_texts(C.id_text(docs, id_col, text_col), rules)
    found = C.materialize(detect(texts, rules), "detections")
    base = found.where("base").groupBy("row").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.collect_set("label").alias("base_set"))
    kept = suppress(found).groupBy("row").agg(
        F.collect_set("label").alias("kept_set"), F.max("confidence").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", "confidence"))).alias("detections"))
    none = F.array().cast("array<string>")
    base_set, kept_set = F.coalesce("base_set", none), F.coalesce("kept_set", none)
    return (texts.select("row", "doc_id", "n_words").join(base, "row", "left").join(kept, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
                    F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(base_set, kept_set)), ",").alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"), "detections"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(C.table(spark, sf_dir, "documents")).drop("detections")


def _sql() -> str:
    rules = all_rules()
    values = ",\n".join(f"({i}, '{r.label}', {r.priority}, {r.confidence}::DOUBLE, '{r.keyword}', '{compile_pattern(r.pattern)}')"
                        for i, r in enumerate(rules))
    phrases = ", ".join(f"('{label}', {phrase.split()!r})" for phrase, label in BASE)
    worst = " ".join(f"WHEN {p} THEN max(e) FILTER (priority <= {p}) OVER w" for p in PRIORITIES)
    return f"""
WITH rules(rule, label, priority, confidence, keyword, regex) AS (VALUES {values}),
phrases(label, words) AS (VALUES {phrases}),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
      '{SEPARATOR}'), lambda x: x <> '') AS ws FROM documents),
place AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
base AS (SELECT doc_id, count(*) AS n_base, min(i - 1) AS first_word, max(i - 1) AS last_word, list(DISTINCT label) AS labels
         FROM place JOIN phrases ON ws[i] = words[1] AND ws[i : i + len(words) - 1] = words GROUP BY doc_id),
m AS (SELECT doc_id, array_to_string(ws, ' ') AS flat, '<' || array_to_string(ws, '><') || '>' AS marked FROM d),
g AS (SELECT doc_id, rule, label, priority, confidence, string_split_regex(marked, regex) AS pieces,
             regexp_extract_all(marked, regex) AS found
      FROM m JOIN rules ON contains(flat, keyword) WHERE regexp_matches(marked, regex)),
x AS (SELECT * EXCLUDE (pieces, found), unnest(range(1, len(found) + 1)) AS i, pieces, found FROM g),
s AS (SELECT doc_id, rule, label, priority, confidence,
             len(array_to_string(pieces[1 : i], '')) - len(replace(array_to_string(pieces[1 : i], ''), '<', ''))
             + len(array_to_string(found[1 : i], '')) - len(replace(array_to_string(found[1 : i], ''), '<', '')) AS e,
             len(found[i]) - len(replace(found[i], '<', '')) AS n FROM x),
k AS (SELECT *, CASE priority {worst} END AS reached FROM s
      WINDOW w AS (PARTITION BY doc_id ORDER BY e - n, e DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS (SELECT doc_id, list(DISTINCT label) AS labels, max(confidence) AS score FROM k WHERE coalesce(reached, 0) < e GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, kept.labels))), ','), '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


OP1_SQL = _sql()
