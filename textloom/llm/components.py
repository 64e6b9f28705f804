"""Connected components of a link table, by alternating large and small stars.

Each round replaces links by links to the smallest node seen, until the table is a set of stars. Minima are
partial aggregates and the joins are plain equi-joins, so a node with very many links is split by Spark's skew
handling; no neighbour list is collected. Rounds are written to the shared folder and grow with the logarithm
of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour of a node is linked to the node's minimum. Small: every smaller one is."""
    both = links.select("a", "b")
    down = both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    around = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else down
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = around.join(least, "u")
    moved = moved.where("v > u") if large else moved.where("v <> m")
    out = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that isn't its own root; root is the component's smallest node."""
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    seen = state(links)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        links = stored(_star(_star(links, large=True), large=False), "links")
        now = state(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
