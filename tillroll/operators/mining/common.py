"""Pieces shared by the three miners.

Itemset table (the normal form every miner returns)::

    [group cols...], items array<string> (sorted), itemset_key string,
    length int, support_count bigint, support double

``group_cols`` lets one job mine many basket sets at once (e.g. every
variant): each group has its own basket count ``n`` and threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import broadcast_if_small, cut_lineage, support_threshold

IN_ROW = 1000  # frequent items that are met inside a basket's row
ITEMSET_COLUMNS = ["items", "itemset_key", "length", "support_count", "support"]


def check_args(min_support: float, max_len: int) -> None:
    if not (0 < float(min_support) <= 1):
        raise ValueError("min_support must be in (0, 1]")
    if int(max_len) < 1:
        raise ValueError("max_len must be >= 1")


def numbered_baskets(baskets: DataFrame, group_cols: list[str], cut=cut_lineage) -> DataFrame:
    """``(group, transaction_id, items)``: distinct sorted items, one row per
    row of ``baskets``.  A row is a basket whatever its id says, so every row
    gets a number of its own in place of the id.  The numbers are fixed by
    writing the table once (a retried task's output is discarded whole); rows
    written by one task are numbered without gaps."""
    return cut(baskets.select(*group_cols, F.monotonically_increasing_id().alias("transaction_id"),
                              F.sort_array(F.array_distinct("items")).alias("items")))


@dataclass
class Thresholds:
    """Basket count and absolute threshold, one per group (or a constant)."""

    group_cols: list[str]
    n: int | None = None
    min_count: int | None = None
    table: DataFrame | None = None  # group cols, n, min_count
    groups: int | None = None       # rows of ``table``

    def keep_frequent(self, counts: DataFrame, count_col: str = "support_count") -> DataFrame:
        if not self.group_cols:
            return counts.filter(F.col(count_col) >= F.lit(self.min_count))
        t = broadcast_if_small(self.table, known_rows=self.groups)
        return counts.join(t, self.group_cols).filter(F.col(count_col) >= F.col("min_count")).drop("min_count")

    def with_support(self, counts: DataFrame) -> DataFrame:
        """Add ``support = support_count / n`` (double division, as the oracle)."""
        if not self.group_cols:
            return counts.withColumn("support", F.col("support_count").cast("double") / F.lit(float(self.n)))
        t = broadcast_if_small(self.table.select(*self.group_cols, "n"), known_rows=self.groups)
        return counts.join(t, self.group_cols).withColumn(
            "support", F.col("support_count").cast("double") / F.col("n").cast("double")
        ).drop("n")


def thresholds(baskets: DataFrame, min_support: float, group_cols: list[str], cut=cut_lineage) -> Thresholds:
    if not group_cols:
        n = baskets.count()
        return Thresholds([], n=n, min_count=support_threshold(min_support, n))
    # one row per group: the number of groups bounds this table
    table = cut(baskets.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "min_count", F.ceil(F.lit(float(min_support)) * F.col("n").cast("double")).cast("bigint")))
    return Thresholds(group_cols, table=table, groups=table.count())


def finish(itemsets: DataFrame, th: Thresholds, group_cols: list[str]) -> DataFrame:
    """``(group, items, support_count)`` -> the normal form."""
    out = th.with_support(itemsets)
    return out.select(
        *group_cols,
        "items",
        F.array_join("items", " ").alias("itemset_key"),
        F.size("items").alias("length"),
        F.col("support_count").cast("bigint").alias("support_count"),
        "support",
    )


def empty_itemsets(spark, group_cols: list[str]) -> DataFrame:
    schema = ", ".join([f"{g} string" for g in group_cols] + [
        "items array<string>", "itemset_key string", "length int", "support_count bigint", "support double"])
    return spark.createDataFrame([], schema)


def trim_baskets(baskets: DataFrame, frequent: DataFrame, rows: int, small: bool, group_cols: list[str]) -> DataFrame:
    """Baskets of at least two frequent items, from ``(group, transaction_id,
    items)``; ``frequent`` has ``rows`` rows and may be broadcast if ``small``.

    A short list of frequent items is met inside the row.  A longer one is
    joined item by item and the baskets are gathered again, in a shuffle of
    the session's width, stated so that AQE does not merge partitions by their
    bytes: the levels that follow do far more work per byte than a scan."""
    keys, width = [*group_cols, "transaction_id"], int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent.filter(F.col("item").isNotNull())
    if small and rows <= IN_ROW:
        listed = frequent.groupBy(*group_cols).agg(F.collect_list("item").alias("_frequent"))
        if group_cols:
            met = baskets.join(F.broadcast(listed), group_cols).withColumn("items", F.array_intersect("items", "_frequent"))
        else:
            met = baskets.withColumn("items", F.array_intersect("items", listed.scalar()))
        return met.select(*keys, "items").filter(F.size("items") >= 2)
    items = baskets.select(*keys, F.explode("items").alias("item"))
    kept = items.join(F.broadcast(frequent) if small else frequent, [*group_cols, "item"], "left_semi").repartition(width, *keys)
    return (kept.groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("items"))
            .filter(F.size("items") >= 2))


def merge_equal(trimmed: DataFrame, group_cols: list[str]) -> DataFrame:
    """Equal baskets of a group as one row: ``transaction_id`` is a struct of
    one of their numbers (``id``) and how many they are (``n``).  Counted with
    partial aggregates, so a basket that recurs in a third of all rows is one
    row per task; then dealt over as many tasks as the session's shuffles have."""
    width = int(trimmed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = trimmed.groupBy(*group_cols, "items").agg(
        F.min("transaction_id").alias("id"), F.count(F.lit(1)).alias("n"))
    return merged.select(*group_cols, F.struct("id", "n").alias("transaction_id"), "items").repartition(
        width, *group_cols, "transaction_id")


def basket_pairs(trimmed: DataFrame, group_cols: list[str], block: int, any_wide: bool = True) -> DataFrame:
    """``(group, transaction_id, items, a, b)``: the item pairs ``a < b`` of
    every basket.  A basket of up to ``block`` items is paired inside its row
    and keeps its items; a wider one is cut into blocks of that many, each
    pair of blocks is a row of its own (spread over tasks, ``items`` null),
    so one huge basket is never expanded in one row.  Only a basket's own
    items are ever paired.  ``any_wide=False``: no basket is wider."""
    keys = [*group_cols, "transaction_id"]
    narrow = trimmed.filter(F.size("items") <= block)
    wide = trimmed.filter(F.size("items") > block)
    inside = narrow.select(*keys, "items", F.explode(in_row_pairs(F.col("items"))).alias("p"))
    inside = inside.select(*keys, "items", "p.a", "p.b")
    if not any_wide:
        return inside
    n = F.ceil(F.size("items") / F.lit(block)).cast("int")
    part = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice("items", i * block + 1, F.lit(block)))
    cut = wide.select(*keys, part.alias("parts")).select(*keys, "parts", F.posexplode("parts").alias("i", "left"))
    both = cut.select(*keys, "left", "i", F.posexplode(F.slice("parts", F.col("i") + 1, F.size("parts"))).alias("j", "right"))
    both = both.repartition(*keys, "i", "j")
    across = F.when(F.col("j") == 0, in_row_pairs(F.col("left"))).otherwise(F.flatten(F.transform(
        "left", lambda x: F.transform("right", lambda y: F.struct(x.alias("a"), y.alias("b"))))))
    empty = F.lit(None).cast("array<string>").alias("items")
    outside = both.select(*keys, empty, F.explode(across).alias("p"))
    return inside.unionByName(outside.select(*keys, "items", "p.a", "p.b"))


def next_candidates(level: DataFrame, k: int, group_cols: list[str]) -> DataFrame:
    """Apriori candidate generation for length ``k >= 3`` from the frequent
    ``(k-1)``-itemsets ``level(group, items)``.

    Join: two itemsets sharing their first ``k-2`` items (an equi-join on the
    prefix) with ``a.last < b.last``.  Prune: every other ``(k-1)``-subset
    (drop one of the first ``k-2`` items) must be frequent, checked with an
    equi-join back to the level and a count per candidate.
    Returns ``(group, prefix array k-1, ext string)``."""
    lv = level.select(*group_cols, "items")
    a = lv.select(*group_cols, F.slice("items", 1, k - 2).alias("p"), F.col("items").alias("prefix"),
                  F.element_at("items", -1).alias("la"))
    b = lv.select(*group_cols, F.slice("items", 1, k - 2).alias("p"), F.element_at("items", -1).alias("ext"))
    joined = a.join(b, [*group_cols, "p"]).filter(F.col("la") < F.col("ext")).select(*group_cols, "prefix", "ext")
    if k == 3:
        # the one subset to check drops the first item: [prefix[1], ext]
        subs = joined.select(*group_cols, "prefix", "ext",
                             F.array(F.element_at("prefix", 2), F.col("ext")).alias("sub"))
        return subs.join(lv.select(*group_cols, F.col("items").alias("sub")), [*group_cols, "sub"], "left_semi").select(
            *group_cols, "prefix", "ext")
    cand = joined.withColumn("cand", F.concat("prefix", F.array("ext")))
    subs = cand.select(*group_cols, "prefix", "ext", "cand",
                       F.explode(F.sequence(F.lit(1), F.lit(k - 2))).alias("drop"))
    subs = subs.withColumn("sub", F.concat(F.slice("cand", 1, F.col("drop") - 1),
                                           F.slice("cand", F.col("drop") + 1, k)))
    found = subs.join(lv.select(*group_cols, F.col("items").alias("sub")), [*group_cols, "sub"], "left_semi")
    return found.groupBy(*group_cols, "prefix", "ext").agg(F.count(F.lit(1)).alias("hits")).filter(
        F.col("hits") == k - 2).select(*group_cols, "prefix", "ext")


def in_row_pairs(items: Column) -> Column:
    """All ``(a, b)`` with ``a`` before ``b`` in a sorted array, built inside
    the row (no shuffle before the partial count)."""
    return F.flatten(F.transform(
        items, lambda x, i: F.transform(F.slice(items, i + 2, F.greatest(F.size(items), F.lit(1))),
                                        lambda y: F.struct(x.alias("a"), y.alias("b")))))
