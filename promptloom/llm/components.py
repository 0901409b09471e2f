"""Connected components of a table of links, by stars that grow towards the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import removed, written


def _stars(links: DataFrame, of_larger: bool) -> DataFrame:
    """Links every neighbour of a node (the larger ones, or the smaller ones with the node itself) to
    the smallest among the node and its neighbours. Minima are taken before the shuffle, and the join
    back is one that Spark can split by size, so that a node with very many links is no hot spot."""
    if of_larger:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.filter("b > a").join(least, "a")
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    # Every link leads from the larger node to the smaller one here.
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    own = least.select("a", F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with links; `links` has two columns of ids, in any order.

    Each round is written to the shared folder and the one before it deleted there; rounds end when a
    round changes nothing, which takes about the logarithm of the largest component's size. The
    component is its smallest id.
    """
    a, b = links.columns
    current = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    current = written(current)
    seen = None
    while True:
        before, current = current, written(_stars(_stars(current, of_larger=True), of_larger=False))
        removed(before)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select("b", "b").distinct()
    )
