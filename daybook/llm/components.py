"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's lowest neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u")
        .join(lowest, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the lowest."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = _lowest(down)
    moved = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").unionByName(lowest.withColumnRenamed("m", "v")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def roots(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (u, v bigint) above its root.

    The root is the lowest node of the component and has no row itself. Each
    round's links are written to the shared folder; nothing but their count
    and checksum comes to the driver. The rounds are logarithmic in the size
    of the longest chain, for a hub of any size: a hub's links are joined,
    never collected.
    """
    now = written(links.filter("u <> v"), "links")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = written(_small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
