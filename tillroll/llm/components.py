"""Connected components of a large edge list, without driver-side unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import cut_lineage


def _star(edges: DataFrame, keep) -> DataFrame:
    """Link the neighbours of every node ``u`` that ``keep`` names, and the
    node itself, to the smallest of ``u`` and its neighbours."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return edges.join(least, "u").filter(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b long): root is the
    smallest node reachable.

    Large-star and small-star steps alternate until nothing changes, which
    takes a number of rounds that grows with the logarithm of the longest
    path.  Every round is a partial aggregate and a join on the node, both of
    written tables, so AQE splits a node with very many neighbours."""
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).filter("u <> v").distinct()
        large = cut_lineage(large)
        # small star: every u > v already; u's smaller neighbours and u itself
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small)
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
