"""Connected components of a table of links, by large-star and small-star steps.

Every step is an aggregation (each node's smallest neighbour) and a join of the links with it.
Links only ever get fewer or point to smaller nodes, until each component is a star around its
smallest node. The links of each round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import Scratch


def _with_smallest(links: DataFrame) -> DataFrame:
    """Rows (u, v) with ``m``, the smallest of u and its v."""
    smallest = links.groupBy("u").agg(F.min("v").alias("_m"))
    # The hint lets the join shuffle both sides itself, so that a hub's links can be split.
    joined = links.join(smallest.hint("rebalance"), "u")
    return joined.select("u", "v", F.least("u", "_m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour."""
    both = links.union(links.select("v", "u"))
    starred = _with_smallest(both).filter(F.col("v") > F.col("u"))
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    starred = _with_smallest(links)
    out = starred.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v")).distinct()


def _print(links: DataFrame) -> tuple:
    """Tells whether a round has changed anything."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, of all nodes but those smallest.

    ``links`` has two columns of long; direction, order, repetition and links of a node to
    itself do not matter.
    """
    a, b = links.columns
    oriented = links.select(
        F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
    )
    now = scratch.store(oriented.filter(F.col("u") != F.col("v")).distinct(), f"{name}-0")
    before, k = _print(now), 0
    while before[0]:
        k += 1
        now = scratch.store(_small_star(_large_star(now)), f"{name}-{k}")
        after = _print(now)
        scratch.drop(f"{name}-{k - 1}")
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
