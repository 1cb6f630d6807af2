"""Vertical (Eclat-style) mining with bitmaps over chunks of baskets.

Baskets are numbered, and an itemset's baskets are kept as bits: a chunk
covers ``words`` * 64 consecutive numbers and is an array of that many 64-bit
words.  The AND of two chunks is the chunk of the joined itemset and its bits
are counted, so no basket id is compared or shipped.

Pairs are counted from the baskets themselves, equal ones merged (a partial
aggregate over each basket's own pairs); the chunks of the frequent ones are built with bitwise
ORs, which are complete before the shuffle, as the numbers of a chunk come
from one task.  From length three on the itemsets that share all but their
last item form a class: its members' chunks meet in one row per chunk number,
that row meets the class's candidates once, and all joined chunks are made
inside the row.  So a level shuffles every member's chunk once per class, not
once per candidate.  A hot item becomes as many rows as there are chunks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.mining.common import (
    basket_pairs, check_args, empty_itemsets, finish, merge_equal, next_candidates, numbered_baskets, thresholds,
    trim_baskets,
)
from tillroll.session import Scratch, cut_lineage, fits, measured

WORDS = 16  # of 64 baskets in a chunk
PAIR_BLOCK = 64


def chunk_bits(tid: str, words: int) -> list[Column]:
    """Aggregates: the words of a chunk, from the numbers of its baskets."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(tid).bitwiseAND(F.lit(63)).cast("int"))
    word = F.pmod(F.shiftright(tid, 6), F.lit(words))
    return [F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0).cast("long")) for i in range(words)]


def _bits(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w).cast("long"))


def classes(chunks: DataFrame, g: list[str]) -> DataFrame:
    """(group, class, chunk, members) from (group, class, last, chunk, bits)."""
    return chunks.groupBy(*g, "class", "chunk").agg(F.collect_list(F.struct("last", "bits")).alias("members"))


def candidates_by_class(cand: DataFrame, k: int, g: list[str]) -> DataFrame:
    """(group, class, plan): each class's members with the items to join them with."""
    each = cand.groupBy(*g, "prefix").agg(F.collect_list("ext").alias("exts"))
    return each.groupBy(*g, F.slice("prefix", 1, k - 2).alias("class")).agg(
        F.collect_list(F.struct(F.element_at("prefix", -1).alias("last"), "exts")).alias("plan"))


def joined_chunks(members: DataFrame, plans: DataFrame, g: list[str]) -> DataFrame:
    """(group, class, last, chunk, bits): the candidates' chunks that are not
    empty; ``class`` is the candidate without its last item."""
    def pairs(plan: Column) -> Column:
        return F.flatten(F.transform(
            F.filter("members", lambda a: a["last"] == plan["last"]),
            lambda a: F.transform(F.filter("members", lambda b: F.array_contains(plan["exts"], b["last"])), lambda b: F.struct(
                a["last"].alias("a"), b["last"].alias("b"),
                F.zip_with(a["bits"], b["bits"], lambda x, y: x.bitwiseAND(y)).alias("bits")))))

    met = members.join(plans, [*g, "class"]).select(
        *g, "class", "chunk", F.explode(F.flatten(F.transform("plan", pairs))).alias("p"))
    return met.select(*g, F.concat("class", F.array("p.a")).alias("class"), F.col("p.b").alias("last"), "chunk",
                      F.col("p.bits").alias("bits")).filter(F.exists("bits", lambda w: w != 0))


def eclat(baskets: DataFrame, min_support: float, max_len: int = 3, group_cols=(), words: int = WORDS,
          buckets: int | None = None) -> DataFrame:
    """``buckets``: so many chunks at least, where there are baskets enough
    for a word in each."""
    check_args(min_support, max_len)
    g = list(group_cols)
    spark = baskets.sparkSession
    with Scratch(spark) as scratch:
        b = numbered_baskets(baskets, g, scratch.cut)
        th = thresholds(b, min_support, g, scratch.cut)
        items = b.select(*g, "transaction_id", F.explode("items").alias("item"))
        l1 = scratch.cut(th.keep_frequent(items.groupBy(*g, "item").agg(F.count(F.lit(1)).alias("support_count"))))
        size = measured(l1)
        if not size[0]:
            return empty_itemsets(spark, g)
        frequent = l1.select(*g, "item")
        levels = [l1.select(*g, F.array("item").alias("items"), "support_count")]
        if max_len >= 2:
            # the baskets of a chunk in one task, so its words are complete before they are shuffled
            width, chunk_of = int(spark.conf.get("spark.sql.shuffle.partitions")), F.shiftright("transaction_id", 10)
            trimmed = scratch.hold(trim_baskets(b, frequent, size[0], fits(*size), g).repartition(width, chunk_of))
            any_wide = not trimmed.filter(F.size("items") > PAIR_BLOCK).isEmpty()
            pairs = basket_pairs(trimmed, g, PAIR_BLOCK, any_wide)
            l2 = scratch.cut(th.keep_frequent(basket_pairs(merge_equal(trimmed, g), g, PAIR_BLOCK, any_wide).groupBy(
                *g, "a", "b").agg(F.sum("transaction_id.n").alias("support_count"))))
            levels.append(l2.select(*g, F.array("a", "b").alias("items"), "support_count"))
        if max_len >= 3:
            if buckets:
                words = max(1, min(words, math.ceil(b.count() / 64 / buckets)))
            size = measured(l2)
            known = l2.select(*g, "a", "b")
            kept = pairs.join(F.broadcast(known) if fits(*size) else known, [*g, "a", "b"], "left_semi")
            chunk = F.floor(F.shiftright("transaction_id", 6) / F.lit(words)).alias("chunk")
            chunks = kept.groupBy(*g, "a", "b", chunk).agg(F.array(*chunk_bits("transaction_id", words)).alias("bits"))
            chunks = chunks.select(*g, F.array("a").alias("class"), F.col("b").alias("last"), "chunk", "bits")
            for k in range(3, max_len + 1):
                cand = scratch.cut(next_candidates(levels[-1], k, g))
                size = measured(cand)
                if not size[0]:
                    break
                plans = candidates_by_class(cand, k, g)
                grown = joined_chunks(classes(chunks, g), F.broadcast(plans) if fits(*size) else plans, g)
                if k < max_len:
                    grown = scratch.cut(grown)
                lk = scratch.cut(th.keep_frequent(grown.groupBy(*g, "class", "last").agg(
                    F.sum(_bits(F.col("bits"))).alias("support_count"))))
                size = measured(lk)
                if not size[0]:
                    break
                levels.append(lk.select(*g, F.concat("class", F.array("last")).alias("items"), "support_count"))
                known = lk.select(*g, "class", "last")
                chunks = grown.join(F.broadcast(known) if fits(*size) else known, [*g, "class", "last"], "left_semi")
        out = reduce(DataFrame.unionByName, [lv.select(*g, "items", "support_count") for lv in levels])
        return cut_lineage(finish(out, th, g))
