"""Level-wise (Apriori) frequent itemsets on the DataFrame API.

Level 1 is an explode + partial count.  Baskets are then trimmed to their
frequent items, equal ones are merged to one row with their number, and cached;
nothing larger is cached or written later.  Each
level counts the candidates that occur in each basket:

* pairs are a basket's own item pairs (``basket_pairs``), counted directly;
* at level ``k`` a basket's occurrences of frequent ``(k-1)``-itemsets meet
  the candidates' extensions (one row per prefix, broadcast behind a size
  check) and are extended by the items the basket has.  A narrow basket does
  so inside its row, before any shuffle; a basket of more than ``wide_width``
  items confirms the extension with a join on ``(basket, item)``, so one huge
  basket is split over many tasks;
* candidates beyond the broadcast limit become a trie that is partitioned by
  first item, and the baskets are routed to the partitions of their items
  (``trie``).

Occurrences are derived again from the trimmed baskets at every level, which
costs a join per level and no storage.  All paths are exact; together they
cover every basket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.mining import trie
from tillroll.operators.mining.common import (
    basket_pairs, check_args, empty_itemsets, finish, merge_equal, next_candidates, numbered_baskets, thresholds,
    trim_baskets,
)
from tillroll.session import BROADCAST_ROW_LIMIT, Scratch, cut_lineage, fits, measured

WIDE_WIDTH = 64


def _count(occ: DataFrame, group_cols: list[str]) -> DataFrame:
    return occ.groupBy(*group_cols, "itemset").agg(F.sum("transaction_id.n").alias("support_count"))


def _extended(occ: DataFrame, cand: DataFrame, wide_items: DataFrame | None, g: list[str]) -> DataFrame:
    """Occurrences ``(group, transaction_id, items, itemset)`` of the
    candidates, which may be broadcast."""
    keys = [*g, "transaction_id"]
    by_prefix = F.broadcast(cand.groupBy(*g, F.col("prefix").alias("itemset")).agg(F.collect_list("ext").alias("exts")))
    met = occ.join(by_prefix, [*g, "itemset"])
    inside = met.filter(F.col("items").isNotNull()).select(
        *keys, "items", "itemset", F.explode(F.array_intersect("exts", "items")).alias("ext"))
    if wide_items is not None:
        outside = met.filter(F.col("items").isNull()).select(*keys, "items", "itemset", F.explode("exts").alias("ext"))
        inside = inside.unionByName(outside.join(wide_items, [*keys, "ext"], "left_semi").select(inside.columns))
    return inside.select(*keys, "items", F.concat("itemset", F.array("ext")).alias("itemset"))


def apriori(baskets: DataFrame, min_support: float, max_len: int = 3, group_cols=(),
            wide_width: int = WIDE_WIDTH, broadcast_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Frequent itemsets of length ``1..max_len`` with ``count >= ceil(min_support * n)``.
    More than ``broadcast_rows`` candidates of a length are never broadcast."""
    check_args(min_support, max_len)
    g = list(group_cols)
    spark = baskets.sparkSession
    with Scratch(spark) as scratch:
        b = numbered_baskets(baskets, g, scratch.cut)
        th = thresholds(b, min_support, g, scratch.cut)
        occ1 = b.select(*g, "transaction_id", F.explode("items").alias("item"))
        l1 = scratch.cut(th.keep_frequent(occ1.groupBy(*g, "item").agg(F.count(F.lit(1)).alias("support_count"))))
        size = measured(l1)
        if not size[0]:
            return empty_itemsets(spark, g)
        levels = [l1.select(*g, F.array("item").alias("itemset"), "support_count")]
        if max_len >= 2:
            frequent = l1.select(*g, "item")
            trimmed = scratch.hold(merge_equal(trim_baskets(b, frequent, size[0], fits(*size), g), g))
            wide = trimmed.filter(F.size("items") > wide_width)
            wide_items = None if wide.isEmpty() else wide.select(
                *g, "transaction_id", F.explode("items").alias("ext"))
            occ = basket_pairs(trimmed, g, wide_width, wide_items is not None).select(
                *g, "transaction_id", "items", F.array("a", "b").alias("itemset"))
            for k in range(2, max_len + 1):
                with trie.co_partitioned(spark):
                    lk = scratch.cut(th.keep_frequent(_count(occ, g)))
                levels.append(lk)
                if k == max_len or lk.isEmpty():
                    break
                cand = scratch.cut(next_candidates(lk.select(*g, F.col("itemset").alias("items")), k + 1, g))
                size = measured(cand)
                if not size[0]:
                    break
                if fits(*size, broadcast_rows):
                    occ = _extended(occ, cand, wide_items, g)
                else:
                    narrow = trimmed.filter(F.size("items") <= wide_width)
                    occ = trie.routed(narrow, occ.filter(F.col("items").isNull()), cand, l1, k + 1, wide_items, g)
        out = reduce(DataFrame.unionByName, [lv.select(*g, "itemset", "support_count") for lv in levels])
        # the itemset table is output-sized; writing it makes downstream plans
        # (rules, comparisons) start from a leaf, after which the caches go
        return cut_lineage(finish(out.withColumnRenamed("itemset", "items"), th, g))
