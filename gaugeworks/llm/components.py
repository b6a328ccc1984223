"""Connected components of a link table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.union(own).filter("a > b").distinct()


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b) that is not its component's least node.

    The links may repeat and point either way; nulls are not allowed. A round is two
    aggregations with joins; the number of rounds grows with the logarithm of the
    component size. Each round is written to the shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    links = materialize(links, "links")
    state = None
    while True:
        row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if row.n == 0 or (row.n, row.h) == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (row.n, row.h)
        links = materialize(_small_star(_large_star(links)), "links")
