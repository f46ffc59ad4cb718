"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, benchmark
decontamination, best-fit packing.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` over all that the stage
before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm.benchmark_index import decontaminate
from adtrail.llm.best_fit_packing import best_fit_packing
from adtrail.llm.language_profiles import UNKNOWN, held_out, identify, train
from adtrail.llm.line_dedup import dedup_lines
from adtrail.llm.ngram_join import jaccard_components


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognisable language; null texts and texts without a
    letter go. The model learns from the folds that are not held out."""
    model = train(docs.where(~held_out()))
    return identify(docs, model).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines. A document of which nothing but blanks is
    left goes; its lines stand in another document."""
    out = dedup_lines(docs).where((F.col("n_removed") == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    changed = {"text": F.col("text"),
               "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast("long")}
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def numbered(docs: DataFrame) -> DataFrame:
    """``number, text, doc``: rows under a number of their own, as ids may be
    null or repeat; ``doc`` has the other columns."""
    return C.materialize(docs.select(F.monotonically_increasing_id().alias("number"), "text",
                                     F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")), "numbered")


def unnumbered(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def without(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows but for those numbers; while these are few, no text is sent to find them."""
    numbers = C.materialize(numbers, "gone")
    return rows.join(C.small(numbers, numbers.count()), "number", "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that with the smallest id, nulls last, and of
    rows with the same id any one."""
    rows = numbered(docs)
    groups = jaccard_components(rows, id_col="number").select(F.col("doc_id").alias("number"), "component_id")
    place = F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.col("number").alias("number"))
    placed = C.materialize(rows.select("number", "doc").join(groups, "number").select("component_id", "number", place.alias("place")), "placed")
    stays = placed.groupBy("component_id").agg(F.min("place")["number"].alias("stays"))
    return unnumbered(without(rows, placed.join(stays, "component_id").where("number <> stays").select("number")), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs, judged row by row."""
    rows = numbered(docs)
    leaks = (decontaminate(rows, C.table(spark, sf_dir, "benchmark"), id_col="number")
             .where("contaminated").select(F.col("doc_id").alias("number")))
    return unnumbered(without(rows, leaks), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in the sequences."""
    return best_fit_packing(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# SQL has neither the language model, SimHash nor the tokenizer: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
