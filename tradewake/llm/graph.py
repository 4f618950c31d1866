"""Connected components of a graph held as a table of links, by alternating star operations.

Each round replaces every link by one to the lowest neighbour, first seen from the lower end
("large star"), then from the upper end ("small star"), until each node has a single link, to a node
that links to nothing lower. The rounds grow with the logarithm of the graph's longest path. Only a
single count per round comes to the driver; each round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored


def _unfinished(links: DataFrame) -> int:
    """Nodes that have two links downwards, or one downwards and one upwards."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.filter((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("up") == 1))).count()


def _large_star(links: DataFrame) -> DataFrame:
    """Link the upper end of each link to the lowest node next to its lower end."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    lowest = both.groupBy("node").agg(F.min("other").alias("low"))
    return links.join(lowest.withColumnRenamed("node", "b"), "b").select("a", F.least("b", "low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its lower neighbours to the lowest of them."""
    lowest = links.groupBy("a").agg(F.min("b").alias("low"))
    joined = links.join(lowest, "a")
    return (
        joined.select("a", F.col("low").alias("b"))
        .union(joined.filter(F.col("b") != F.col("low")).select("b", "low"))
        .distinct()
    )


def lowest_reachable(links: DataFrame) -> DataFrame:
    """(node, root): for every node with a link, the lowest node it reaches.

    ``links`` has two columns of ids, in either order. Nulls, links of a node to itself and repeated
    links are of no effect; with no links the result is empty.
    """
    one, other = (F.col(name) for name in links.columns[:2])
    links = stored(
        links.filter(one != other).select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).distinct(),
        "links",
    )
    while _unfinished(links):
        links = stored(_small_star(_large_star(links)), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", F.col("b").alias("root")).distinct()
    )
