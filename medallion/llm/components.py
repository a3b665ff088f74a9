"""Connected components of links, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); nodes have the same root when a path joins them.

    Each round points every node to its neighbour of the smallest random rank, itself included, and replaces nodes
    by what they point to. With ranks drawn anew, a round leaves at most a fraction of the nodes, whatever the shape
    of the graph; the rounds are then read back in order. A node's neighbours are merged before the shuffle, so a
    hub is no hot spot, and each round is written, so a lost executor costs one round's tasks.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while not rounds or not links.isEmpty():
        def ranked(node: str, salt: int = len(rounds)):
            return F.struct(F.xxhash64(F.col(node), F.lit(salt)).alias("rank"), F.col(node).alias("node"))

        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min(ranked("b")).alias("best"))
        points = stored(smallest.select(F.col("a").alias("node"), F.least("best", ranked("a"))["node"].alias("root")), "points")
        rounds.append(points)
        ends = [points.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in ("a", "b")]
        moved = links.join(ends[0], "a").join(ends[1], "b").where("a_root <> b_root")
        links = stored(
            moved.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "links"
        )
    roots = rounds[0]
    for points in rounds[1:]:
        on = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = roots.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return roots
