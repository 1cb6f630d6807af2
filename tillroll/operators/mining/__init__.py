"""Frequent-itemset miners; all return the same normal form (see ``common``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.mining.fpgrowth import fpgrowth
from tillroll.operators.mining.levelwise import apriori
from tillroll.operators.mining.vertical import eclat

METHODS = {"apriori": apriori, "fpgrowth": fpgrowth, "eclat": eclat}


def mine(baskets: DataFrame, min_support: float, max_len: int = 3, method: str = "apriori",
         group_cols=()) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; expected one of {sorted(METHODS)}")
    return METHODS[method](baskets, min_support, max_len, group_cols=group_cols)


def ordered(itemsets: DataFrame) -> DataFrame:
    """Normal-form order: length asc, support desc, itemset asc."""
    return itemsets.orderBy(F.asc("length"), F.desc("support"), F.asc("itemset_key"))


def frequent_items(baskets: DataFrame, min_support: float) -> DataFrame:
    """Frequent single items (level 1 only)."""
    return apriori(baskets, min_support, 1)
