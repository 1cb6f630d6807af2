"""Post-processing of itemset tables: names, length filter, top results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import broadcast_if_small


def with_product_names(itemsets: DataFrame, names: DataFrame) -> DataFrame:
    """``product_names``: item names joined by `` | `` in item order; an
    unknown item keeps its id.  Names are catalogue-sized (broadcast behind
    the row check); the regroup is per itemset (output-sized)."""
    exploded = itemsets.select("itemset_key", F.posexplode("items").alias("pos", "item"))
    named = exploded.join(broadcast_if_small(names.select(F.col("article_id").alias("item"), "prod_name")),
                          "item", "left")
    parts = named.groupBy("itemset_key").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.coalesce("prod_name", "item").alias("n")))).alias("p"))
    return itemsets.join(parts.select("itemset_key", F.array_join(F.transform("p", lambda s: s["n"]), " | ")
                                      .alias("product_names")), "itemset_key")


def min_length(itemsets: DataFrame, min_itemset_length: int) -> DataFrame:
    """Keep ``length >= min_itemset_length``; support desc, length desc, key asc."""
    return itemsets.filter(F.col("length") >= min_itemset_length).orderBy(
        F.desc("support"), F.desc("length"), F.asc("itemset_key"))


def top_itemsets(itemsets: DataFrame, min_itemset_length: int, n: int) -> DataFrame:
    return min_length(itemsets, min_itemset_length).limit(n)


def combo_cards(itemsets: DataFrame, min_itemset_length: int, top_results: int, cards: int = 6) -> DataFrame:
    """Combos of two or more items from the top results, with their position
    in that (unfiltered by size) list; at most ``cards``."""
    top = top_itemsets(itemsets, min_itemset_length, top_results)
    # ``top`` has at most ``top_results`` rows: this window is over a top-k list
    w = Window.orderBy(F.desc("support"), F.desc("length"), F.asc("itemset_key"))
    ranked = top.withColumn("position", F.row_number().over(w))
    return ranked.filter(F.col("length") >= 2).orderBy("position").limit(cards).select(
        "position", "itemset_key", "length", "support_count", "support")
