"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm import common as C


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One half round: each node's neighbours (the larger or the smaller ones)
    are tied to the smallest node of its neighbourhood. Only minima are
    gathered, so a node with very many links costs one row a task."""
    both = edges if not larger else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    tied = both.join(least, both["a"] == least["u"])
    if larger:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a > b) are stars: every node has one smaller
    neighbour at most, and none both a smaller and a larger one. Stars hang
    on the smallest node of their component."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node that
    has a link to another. ``links``: a, b (long). Large-star and small-star
    rounds until only stars are left; every round is written to the shared
    folder. Links that are stars already, as from an earlier call, cost no
    round."""
    edges = C.materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(edges):
        # the rows of a large-star half round are as many as the edges at most, so repeats go once a round
        edges = C.materialize(_star(_star(edges, True), False).distinct(), "edges")
    # every node now hangs directly on its component's smallest node
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
