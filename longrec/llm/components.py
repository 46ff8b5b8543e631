"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (x, y); nodes of one component share their root.

    Each round maps every node to its smallest neighbour (itself included) and keeps the
    links between different images, until none is left; the rounds are then composed.  Node
    ids must be spread like hashes, which makes the number of rounds logarithmic.  Nothing but
    pre-aggregated minima meets in one group, and the joins can be split at busy nodes.
    """
    links = cut_lineage(links.where("x != y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    rounds = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        image = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("image"))
        rounds.append(cut_lineage(image.select(F.col("x").alias("node"), "image")))
        at_x = rounds[-1].select(F.col("node").alias("x"), F.col("image").alias("ix"))
        at_y = rounds[-1].select(F.col("node").alias("y"), F.col("image").alias("iy"))
        moved = links.join(at_x, "x").join(at_y, "y").where("ix != iy")
        links = cut_lineage(moved.select(F.least("ix", "iy").alias("x"), F.greatest("ix", "iy").alias("y")).distinct())
    if not rounds:
        return links.select(F.col("x").alias("node"), F.col("y").alias("root"))
    roots = rounds[0].select("node", F.col("image").alias("root"))
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("root"), "image")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("image", "root").alias("root"))
    return cut_lineage(roots)
