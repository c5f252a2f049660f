"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _step(edges: DataFrame) -> DataFrame:
    """One large-star step and one small-star step over (a, b), a > b.

    Large star: every neighbour above a node is linked with the least neighbour.  Small star: every neighbour
    below a node, and the node, are linked with the least one.  Least neighbours come from a partial
    aggregate and go back by a join, whose hot keys the planner splits, so a hub never sits in one task.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    down = large.join(low, "a")
    small = down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: any type that sorts); root is the component's least node.

    Self links are ignored, nulls are no nodes, repeated and reversed edges count once; no edges give no rows.
    The rounds end when the edges are stars, which takes about the logarithm of the longest path.
    """
    seen = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen, before = written(seen, "edges"), None
    for _ in range(most_rounds):
        now = seen.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return seen.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                seen.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        after = written(_step(seen), "edges")
        forget(seen)
        seen, before = after, now
    raise RuntimeError("components did not settle")
