"""Comparison of the itemsets found by several methods (set operations)."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def method_long(results: dict[str, DataFrame]) -> DataFrame:
    """``(method, itemset_key)`` for every method's itemsets."""
    parts = [df.select(F.lit(name).alias("method"), "itemset_key") for name, df in results.items()]
    return reduce(DataFrame.unionByName, parts)


def _keyed(long: DataFrame) -> DataFrame:
    return long.groupBy("itemset_key").agg(F.collect_set("method").alias("methods"))


def common_itemsets(long: DataFrame, methods: list[str]) -> DataFrame:
    """Number of itemsets found by every method (one pass, no chained intersect)."""
    return _keyed(long).agg(F.count_if(F.size("methods") == len(set(methods))).alias("common_itemsets"))


def pairwise_differences(long: DataFrame, methods: list[str]) -> DataFrame:
    """For each pair (names sorted): itemsets only in the left, only in the right."""
    keyed = _keyed(long)
    pairs = list(combinations(sorted(methods), 2))
    aggs = []
    for i, (left, right) in enumerate(pairs):
        has_l, has_r = F.array_contains("methods", left), F.array_contains("methods", right)
        aggs += [F.count_if(has_l & ~has_r).alias(f"l{i}"), F.count_if(has_r & ~has_l).alias(f"r{i}")]
    wide = keyed.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f"{l}_vs_{r}").alias("pair"), F.lit(l).alias("left_method"),
                              F.lit(r).alias("right_method"), F.col(f"l{i}").alias("only_left"),
                              F.col(f"r{i}").alias("only_right")) for i, (l, r) in enumerate(pairs)])
    return wide.select(F.inline(rows)).withColumn("total_difference", F.col("only_left") + F.col("only_right"))


def method_agreement(summary: DataFrame) -> DataFrame:
    """Do all methods report the same number of itemsets?"""
    return summary.agg(
        F.count(F.lit(1)).alias("methods"),
        (F.count_distinct("frequent_itemsets") == 1).alias("all_agree"),
        F.min("frequent_itemsets").alias("min_itemsets"),
        F.max("frequent_itemsets").alias("max_itemsets"),
    )
