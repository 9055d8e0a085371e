"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every neighbour of a node is hung under the node's smallest neighbour: the larger ones (large star) or the smaller ones (small star)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    hung = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else joined.select("b", "m").toDF("a", "b").unionByName(least.toDF("a", "b"))
    return hung.where("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the component's smallest node. Each round is a written table."""
    edges, before = written(links.where("a <> b").distinct(), "edges"), None
    for _ in range(most_rounds):
        edges = written(_star(written(_star(edges, True), "edges"), False), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.toDF("node", "label").unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
