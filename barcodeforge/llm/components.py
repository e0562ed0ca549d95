"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barcodeforge.llm.common import stage_table


def _only_stars(links: DataFrame) -> bool:
    """Whether no node of ``links(u, v)`` has two smaller neighbours, or one on either side."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of ``edges(src, dst)``.

    Every step links nodes to the smallest neighbour they know: the large-star step moves the
    larger neighbours of a node, the small-star step the smaller ones. A star's centre is met
    by a partial minimum before the shuffle, and the joins back to the edges are ones that Spark
    can split at a hot centre; none is broadcast, so nothing of them passes the driver. Each step
    is written to the shared folder, and the last one is known by its shape: every node has
    one edge, or is the centre of such. Nodes without an edge to another node are not returned;
    null ends are ignored.

    Returns ``node, component``.
    """
    links = stage_table(edges.where("src <> dst")
                        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    while not _only_stars(links):
        both = links.union(links.select("v", "u")).toDF("a", "b")
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.where("b > a").join(least.hint("merge"), "a")
                 .select(F.col("b").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low.hint("merge"), "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u <> v").distinct())
        links = stage_table(small)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select("v", "v").distinct().toDF("node", "component"))
