"""Connected components of a link table by alternating large and small stars, in DataFrame operations.

Every step replaces a node's links by links to the smallest node it sees, so the links shrink towards one
star per component. Steps are written to the shared folder: the lineage stays short and a lost executor
rereads files. The number of rounds grows with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import written


def _smallest(links: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of each node, reduced map-side first."""
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("l")).select("l.u", "l.v")


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = _smallest(near).select("u", F.least("u", "m").alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node; the root, the smallest node of its component, included.

    ``links`` has long columns ``a`` and ``b``; null ends, links of a node to itself and repeated links
    are passed over. No links: no rows.
    """
    links = written(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
