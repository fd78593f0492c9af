"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved


def _nearest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _nearest(both).select("a", F.least("a", "low").alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every link goes from its larger end ``a`` to its smaller end ``b``."""
    low = _nearest(links)
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.where("a <> b").unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node that has a link; ``root`` is the smallest node it can reach.

    ``links`` has two columns ``a`` and ``b`` of one ordered type. Alternating large and small stars (Kiveris and others,
    2014) takes O(log² n) rounds; each is written to the shared folder, so that lineage stays short. Sums and minima
    are combined before the shuffle, so a node with very many links is no single task. Self links and repeated links
    change nothing, rows with a null end are left out, no link gives no rows.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = saved(links, "links"), None
    for _ in range(most_rounds):
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        links = saved(_small_star(_large_star(links)), "links")
    else:
        raise RuntimeError("the components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
