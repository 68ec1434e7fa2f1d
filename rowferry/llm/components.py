"""Connected components of a table of links, by large and small stars.

Each round links every node's larger neighbours, then all its neighbours that
are not larger, to the smallest of them. Rounds end when the links are stars.
Minima are combined before the shuffle. A node with more than ``HOT_DEGREE``
links is joined by broadcast, so that its links stay spread over the tasks;
there is at most one such node for so many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import discard, staged

HOT_DEGREE = 10_000


def components(links: DataFrame) -> DataFrame:
    """``node, root`` from links ``a, b`` of type bigint; ``root`` is the smallest node reachable.

    Roots are rows too. Links of a node to itself and links with null say
    nothing; nodes without other links are not in the result.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links",
    )
    while not _are_stars(edges):
        large = staged(_large_star(edges), "large-star")
        small = staged(_small_star(large), "small-star")
        discard(edges, large)
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one parent, which has none."""
    children = edges.groupBy("u").agg(F.count("*").alias("parents"))
    if not children.where("parents > 1").isEmpty():
        return False
    parents = edges.select(F.col("v").alias("u")).distinct()
    return parents.join(children, "u", "left_semi").isEmpty()


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v`` and ``least``, the smallest ``v`` of each ``u``."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("degree"))
    hot = F.broadcast(least.where(F.col("degree") > HOT_DEGREE).select("u", "least"))
    rest = least.where(F.col("degree") <= HOT_DEGREE).select("u", "least")
    return edges.join(hot, "u").unionAll(edges.join(rest, "u"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _with_least(both).where("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The edges lead from the larger to the smaller node."""
    found = _with_least(edges)
    low = found.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return low.unionAll(found.select("u", F.col("least").alias("v"))).distinct()
