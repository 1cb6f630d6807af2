"""One call from baskets to patterns: mine, filter, rules, summary, top results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import baskets as B
from tillroll.operators import itemsets as IS
from tillroll.operators import mining
from tillroll.operators import rules as R
from tillroll.session import cut_lineage, held


@dataclass
class Patterns:
    itemsets: DataFrame   # of at least the asked length
    rules: DataFrame      # of at least the asked length
    top: DataFrame        # the first itemsets
    summary: DataFrame    # one row


def find_patterns(baskets: DataFrame, min_support: float, max_len: int, min_confidence: float, min_length: int = 2,
                  top: int = 20, method: str = "apriori", **load) -> Patterns:
    """``load`` goes to ``load_baskets`` (dates, first N, top items, size)."""
    tx = B.load_baskets(baskets, **load) if load else baskets
    with held(tx) as tx:
        found = mining.mine(tx, min_support, max_len, method)
        stats = B.basket_stats(tx)
        long = IS.min_length(found, min_length)
        rules = cut_lineage(R.rules_min_length(R.association_rules(found, min_confidence), min_length))
        counts = found.agg(F.count_if(F.col("length") >= min_length).alias("frequent_itemsets"),
                           F.count(F.lit(1)).alias("total_frequent_itemsets"))
        summary = cut_lineage(stats.select(
            "transactions", "unique_items", counts.select("frequent_itemsets").scalar().alias("frequent_itemsets"),
            counts.select("total_frequent_itemsets").scalar().alias("total_frequent_itemsets"),
            rules.select(F.count(F.lit(1))).scalar().alias("rules")))
    return Patterns(long, rules, IS.top_itemsets(found, min_length, top), summary)
