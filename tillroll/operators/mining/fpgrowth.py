"""FP-growth on DataFrames: projected databases with a bound on the depth.

A basket becomes a path: its frequent items, the most frequent first (ties by
item).  Equal paths are one row with a count, which is what the FP-tree's
shared branches save.  The projected database of an itemset holds what lies
before its items on the paths through it; equal pieces are again one row with
a count.  Growing an itemset by an item of its projected database gives the
next length, so the search goes through the itemsets that occur and generates
no candidates.  The depth is the itemset's length: databases are projected for
itemsets shorter than ``max_len`` only, and no longer itemset is ever formed.

Scale: a database row is keyed by itemset and path, so the rows of an itemset
that a third of all baskets hold are spread by their paths; extensions are
counted with partial aggregates.  A path longer than ``BLOCK`` is cut into
blocks of places that are projected in different tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.mining.common import (
    check_args, empty_itemsets, finish, merge_equal, numbered_baskets, thresholds, trim_baskets,
)
from tillroll.session import Scratch, cut_lineage, fits, measured

BLOCK = 64


def paths(merged: DataFrame, l1: DataFrame, small: bool, g: list[str]) -> DataFrame:
    """(group, path, n) from the merged baskets of at least two frequent
    items: the most frequent items first.  The shuffle has the session's
    width, as the rows that follow are much more than a path."""
    keys, width = [*g, "transaction_id"], int(merged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = l1.select(*g, "item", (-F.col("support_count")).alias("less"))
    items = merged.select(*keys, F.explode("items").alias("item"))
    kept = items.join(F.broadcast(rank) if small else rank, [*g, "item"]).repartition(width, *keys)
    ordered = kept.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("less", "item"))).alias("p"))
    return ordered.select(*g, F.col("p.item").alias("path"), F.col("transaction_id.n").alias("n"))


def projected(rows: DataFrame, g: list[str], block: int = BLOCK) -> DataFrame:
    """(group, itemset, path, n): the databases of the itemsets grown by each
    item of a path, from ``(group, itemset, path, n)``.  Items that begin a
    path have nothing before them and give no row."""
    keys = [*g, "itemset"]
    short, long = rows.filter(F.size("path") <= block), rows.filter(F.size("path") > block)
    places = F.posexplode(F.slice("path", F.col("from") + 1, F.lit(block))).alias("at", "item")
    blocks = F.explode(F.sequence(F.lit(0), F.size("path") - 1, F.lit(block))).alias("from")
    cut = long.select(*keys, "path", "n", blocks).repartition(*keys, F.xxhash64("path"), "from")
    each = short.withColumn("from", F.lit(0)).unionByName(cut.select(*short.columns, "from")).select(
        *keys, "path", "n", "from", places)
    grown = each.select(*g, F.concat("itemset", F.array("item")).alias("itemset"), "n",
                        F.slice("path", F.lit(1), F.col("from") + F.col("at")).alias("path"))
    return grown.filter(F.size("path") > 0).groupBy(*keys, "path").agg(F.sum("n").alias("n"))


def fpgrowth(baskets: DataFrame, min_support: float, max_len: int = 3, group_cols=()) -> DataFrame:
    check_args(min_support, max_len)
    g = list(group_cols)
    keys = [*g, "itemset"]
    spark = baskets.sparkSession
    with Scratch(spark) as scratch:
        b = numbered_baskets(baskets, g, scratch.cut)
        th = thresholds(b, min_support, g, scratch.cut)
        items = b.select(*g, "transaction_id", F.explode("items").alias("item"))
        l1 = scratch.cut(th.keep_frequent(items.groupBy(*g, "item").agg(F.count(F.lit(1)).alias("support_count"))))
        size = measured(l1)
        if not size[0]:
            return empty_itemsets(spark, g)
        levels = [l1.select(*g, F.array("item").alias("itemset"), "support_count")]
        if max_len >= 2:
            trimmed = trim_baskets(b, l1.select(*g, "item"), size[0], fits(*size), g)
            tree = paths(merge_equal(trimmed, g), l1, fits(*size), g)
            rows = projected(tree.withColumn("itemset", F.array().cast("array<string>")), g)
        for k in range(2, max_len + 1):
            if k < max_len:
                rows = scratch.cut(rows)
            each = rows.select(*keys, "n", F.explode("path").alias("item"))
            lk = scratch.cut(th.keep_frequent(each.groupBy(*keys, "item").agg(F.sum("n").alias("support_count"))))
            size = measured(lk)
            if not size[0]:
                break
            levels.append(lk.select(*g, F.concat("itemset", F.array("item")).alias("itemset"), "support_count"))
            if k < max_len:
                grows = lk.groupBy(*keys).agg(F.collect_list("item").alias("items"))
                met = rows.join(F.broadcast(grows) if fits(*size) else grows, keys)
                # the order of the path is kept; only items that grow the itemset are followed
                rows = projected(met.select(*keys, F.array_intersect("path", "items").alias("path"), "n"), g)
        out = reduce(DataFrame.unionByName, [lv.select(*g, "itemset", "support_count") for lv in levels])
        return cut_lineage(finish(out.select(*g, F.sort_array("itemset").alias("items"), "support_count"), th, g))
