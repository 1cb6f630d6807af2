"""Candidates too many to broadcast: a trie partitioned by first item.

A candidate belongs to the partition of its first item.  A trimmed basket is
routed once for each of its items that begins a candidate, with the items
behind it; there it walks the trie node by node.  Both sides are partitioned
by ``(group, first, salt)`` and stay so, so the walk itself shuffles nothing:
what moves is one row per basket and first item, whatever the level, and no
row per occurrence of an itemset.

A first item that many baskets hold has several salts (from its support, which
is known): its baskets are dealt over them and its part of the trie is copied
to each, so no task gets more than about ``ROUTES`` baskets of one item.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import broadcast_if_small

ROUTES = 1_000_000  # baskets of one first item in a task


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Plans made inside may join on more columns than both sides are
    partitioned by without a further shuffle."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _starts(cand: DataFrame, l1: DataFrame, g: list[str], routes: int) -> DataFrame:
    """(group, first, salts): the items that begin a candidate."""
    firsts = cand.select(*g, F.col("prefix")[0].alias("first")).distinct()
    counted = l1.select(*g, F.col("item").alias("first"),
                        F.ceil(F.col("support_count") / F.lit(routes)).cast("int").alias("salts"))
    return broadcast_if_small(counted.join(firsts, [*g, "first"], "left_semi"))


def routed(narrow: DataFrame, wide_occ: DataFrame, cand: DataFrame, l1: DataFrame, k: int,
           wide_items: DataFrame | None, g: list[str], routes: int = ROUTES) -> DataFrame:
    """Occurrences ``(group, transaction_id, items, itemset)`` of the
    candidates ``(group, prefix, ext)`` of length ``k``.  ``narrow``: trimmed
    baskets; ``items`` of their occurrences are those behind the itemset's
    first item.  ``wide_occ``: occurrences of ``(k-1)``-itemsets in baskets too
    wide for that, whose extension is confirmed on ``wide_items``."""
    width = int(cand.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, place = [*g, "transaction_id"], [*g, "first", "salt"]
    starts = _starts(cand, l1, g, routes)
    salt = F.pmod(F.xxhash64("transaction_id"), F.col("salts")).cast("int").alias("salt")

    def dealt(nodes: DataFrame) -> DataFrame:
        """Trie nodes in the partitions of their first items, all salts."""
        every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
        copies = nodes.withColumn("first", F.col("node")[0]).join(starts, [*g, "first"]).select(
            *g, "first", every, *[c for c in nodes.columns if c not in g])
        return copies.repartition(width, *place).hint("shuffle_hash")

    leaves = dealt(cand.groupBy(*g, F.col("prefix").alias("node")).agg(F.collect_list("ext").alias("exts")))
    behind = F.slice("all", F.col("at") + 2, F.greatest(F.size("all"), F.lit(1)))
    walk = (narrow.select(*keys, F.col("items").alias("all"), F.posexplode("items").alias("at", "first"))
            .select(*keys, "first", behind.alias("items")).filter(F.size("items") >= k - 1)
            .join(starts, [*g, "first"]).select(*place[:-1], salt, "transaction_id", "items")
            .repartition(width, *place).select("*", F.array("first").alias("node"), F.col("items").alias("rest")))
    for depth in range(2, k):
        step = walk.select(*place, "transaction_id", "items", F.col("node").alias("up"), F.col("rest").alias("all"),
                           F.posexplode("rest").alias("at", "next"))
        step = step.select(*place, "transaction_id", "items", F.concat("up", F.array("next")).alias("node"),
                           behind.alias("rest")).filter(F.size("rest") >= k - depth)
        nodes = leaves if depth == k - 1 else dealt(cand.select(*g, F.slice("prefix", 1, depth).alias("node")).distinct())
        walk = step.join(nodes, [*place, "node"])
    inside = walk.select(*keys, "items", "node", F.explode(F.array_intersect("exts", "rest")).alias("ext"))
    if wide_items is not None:
        met = (wide_occ.select(*keys, F.col("itemset").alias("node"), F.col("itemset")[0].alias("first"))
               .join(starts, [*g, "first"]).select(*place[:-1], salt, "transaction_id", "node")
               .repartition(width, *place).join(leaves, [*place, "node"]))
        outside = met.select(*keys, "node", F.explode("exts").alias("ext")).join(wide_items, [*keys, "ext"], "left_semi")
        none = F.lit(None).cast("array<string>").alias("items")
        inside = inside.unionByName(outside.select(*keys, none, "node", "ext"))
    return inside.select(*keys, "items", F.concat("node", F.array("ext")).alias("itemset"))
