"""Connected components of a graph of links, by large and small stars.

Both steps replace links by links to the least neighbour and keep components as they are:
a large star moves the larger neighbours of a node to its least neighbour, a small star
moves the smaller ones. They alternate until every node is linked to the least node of
its component alone. The number of rounds grows with the logarithm of a component's size.
No component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import stored


def _starred(links: DataFrame) -> DataFrame:
    """``links(node, other)`` with the least of a node and all its others.

    The least ones are stored, so that the join deals both sides anew and may split a
    node with a large part of all links.
    """
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    least = stored(least.select("node", F.least("node", "least").alias("least")), "least")
    return links.join(least, "node")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("other", "node"))
    moved = _starred(both).filter(F.col("other") > F.col("node"))
    return moved.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every link goes from its larger node to its smaller one, as a large star makes them."""
    starred = _starred(links)
    moved = starred.select(F.col("other").alias("node"), F.col("least").alias("other"))
    own = starred.select("node", F.col("least").alias("other"))
    return moved.union(own).filter(F.col("node") != F.col("other")).distinct()


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    hashed = F.xxhash64("node", "other")
    found = links.agg(F.count(F.lit(1)), F.sum(hashed.bitwiseAND(0xFFFFFFFF))).first()
    return tuple(found)


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link to another; ``root`` is the least node of
    its component and has no row itself.

    ``links`` has bigint columns ``node`` and ``other``; their direction, repeats and links to
    the node itself do not matter. No links give no rows.
    """
    current = links.filter(F.col("node") != F.col("other")).select(
        F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
    )
    current = stored(current.distinct(), "links")
    before = _mark(current)
    while True:
        current = stored(_small_star(stored(_large_star(current), "large-star")), "small-star")
        after = _mark(current)
        if after == before:
            return current.withColumnRenamed("other", "root")
        before = after
