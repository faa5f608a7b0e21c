"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import drop_tables, release, written


def connected_components(links: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Nodes ``k`` with ``root``, the least node of their component, for links (``a``, ``b``), repeated ones too.

    Large-star and small-star steps in turn: every node hands its greater neighbours, then its smaller ones, to its least
    neighbour. Neighbours are only reduced to their minimum and maximum, never gathered, and each step is a written
    table. It ends when every node is a root or has its root for its only neighbour, which the minima and maxima show, so no
    round is spent on finding that nothing changes. The number of rounds grows with the logarithm of the longest path.
    """
    current = written(_downward(links), f"{name}_links")
    for _ in range(rounds + 1):
        least = written(_least(current), f"{name}_least")
        if not least.agg(F.max("unsettled")).head()[0]:
            drop_tables([current])
            return least.select(F.col("a").alias("k"), F.col("m").alias("root"))
        stars = written(_large_star(current, least), f"{name}_stars")
        lower = written(stars.groupBy("a").agg(F.min("b").alias("m")), f"{name}_lower")
        done = [current, least, stars, lower]
        current = written(_small_star(stars, lower), f"{name}_links")
        drop_tables(done)
        release(links.sparkSession)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from the greater node to the smaller."""
    pair = links.where(~F.col("a").eqNullSafe(F.col("b")))
    return pair.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _least(links: DataFrame) -> DataFrame:
    """Each node ``a`` with ``m``, the least of it and its neighbours, and whether it has a smaller neighbour and another one.

    Written before it is joined, so that the join is one of plain tables and Spark splits a node with very many neighbours.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low, high = F.col("low"), F.col("high")
    unsettled = (low < F.col("a")) & (low < high)
    found = both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
    return found.select("a", F.least(low, "a").alias("m"), unsettled.alias("unsettled"))


def _large_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """As many links as before; repeats stay, which costs less than another shuffle to drop them."""
    greater = links.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return greater.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, lower: DataFrame) -> DataFrame:
    """No more links than before: each node's link to its least neighbour takes the place of one that falls away."""
    handed = links.join(lower, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.union(lower.select("a", F.col("m").alias("b")))
