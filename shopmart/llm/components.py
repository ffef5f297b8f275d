"""Connected components of links between numbers, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import stored


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and itself, are linked to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_least(down), "u")
    moved = joined.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = _least(down).select("u", F.col("least").alias("v"))
    return moved.unionByName(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """Node and root (the least node of its component) of all linked nodes but roots.

    ``links`` has two numeric columns u and v, in any order and repeated or not. Every round
    is written to the shared folder and cuts the lineage; the loop ends when a
    round changes nothing, after about log2 of the longest path rounds.
    """
    links = stored(links.where("u <> v").select("u", "v").distinct(), "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(links)
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        after = state(links)
        if after == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
