"""Connected components by alternating star contractions.

Each round is two joins with a pre-aggregated minimum: the large star links
the larger neighbours of a node to the least of its neighbourhood, the small
star does so with the others. Rounds end when the links no longer change;
their number grows with the logarithm of the longest path. A node with very
many links is a skewed join key whose rows Spark splits, never one group, and
links never come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.tables import staged


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is the least node
    of its component. Loops and repeated links do no harm; null ends are left out."""
    links = _down(links.select(F.col(left).alias("a"), F.col(right).alias("b")))
    links = staged(links, "links")
    state = _state(links)
    while state[0]:
        links = staged(_small_star(staged(_large_star(links), "links-large")), "links-small")
        before, state = state, _state(links)
        if state == before:
            break
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def _down(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node."""
    return links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(20,0)")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _down(both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"),
                                                                              F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.unionByName(least.select("a", F.col("m").alias("b"))))
