"""Basket loading and filtering (B1-B10).

Order of the steps is part of the semantics: date filter -> first N ->
parse -> occurrence counts -> top items -> restrict -> distinct -> min size.
So N counts baskets before the size filter, and support later is relative to
the baskets left after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import parse_items
from tillroll.operators.prep import dense_ids
from tillroll.operators.selection import first_rows
from tillroll.session import broadcast_if_small, cut_lineage


IN_ROW = 1000  # allowed items that are met inside a basket's row


def date_filter(baskets: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Closed interval on the text day; either end may be open.  Pushed into
    the Parquet scan as a range predicate when reading stored baskets."""
    out = baskets
    if start_date is not None:
        out = out.filter(F.col("t_dat") >= F.lit(start_date))
    if end_date is not None:
        out = out.filter(F.col("t_dat") <= F.lit(end_date))
    return out


def first_n(baskets: DataFrame, max_baskets: int | None) -> DataFrame:
    """First ``max_baskets`` baskets in (day, customer) order; 0/None = all."""
    if not max_baskets:
        return baskets
    return first_rows(baskets, max_baskets, ["t_dat", "customer_id"])


def with_parsed_items(baskets: DataFrame, column: str = "items", pad_width: int | None = 10) -> DataFrame:
    """Parse text item lists (B1); arrays are passed through."""
    dtype = dict(baskets.dtypes)[column]
    if dtype.startswith("array"):
        return baskets
    return baskets.withColumn(column, parse_items(column, pad_width))


def item_frequency(baskets: DataFrame) -> DataFrame:
    """Occurrences per item (an item repeated in one basket counts twice)."""
    return baskets.select(F.explode("items").alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("frequency")
    )


def top_items(baskets: DataFrame, n: int | None) -> DataFrame:
    """Top-``n`` items by occurrences, ties by item ascending; 0/None = all."""
    freq = item_frequency(baskets)
    if not n:
        return freq
    return freq.orderBy(F.desc("frequency"), F.asc("item")).limit(n)


def restrict_items(baskets: DataFrame, allowed: DataFrame) -> DataFrame:
    """Keep only allowed items inside each basket, distinct and sorted; a
    basket without any allowed item stays, empty.

    A row is a basket, whatever its id says.  A short list is met inside the
    row; for a longer one the rows are numbered on a written table and
    regrouped by that number."""
    allowed = cut_lineage(allowed.select("item").distinct())
    if allowed.count() <= IN_ROW:
        return _restricted_in_row(baskets, allowed)
    return _restricted(_numbered(baskets), allowed).drop("_row")


def _restricted_in_row(baskets: DataFrame, allowed: DataFrame) -> DataFrame:
    listed = allowed.filter(F.col("item").isNotNull()).agg(F.collect_list("item")).scalar()
    none = F.array().cast("array<string>")
    return baskets.withColumn("items", F.sort_array(F.coalesce(F.array_intersect("items", listed), none)))


def _numbered(baskets: DataFrame) -> DataFrame:
    return cut_lineage(baskets.withColumn("_row", F.monotonically_increasing_id()))


def _restricted(numbered: DataFrame, allowed: DataFrame) -> DataFrame:
    """Items meet the top-N list in a broadcast join (one lookup per item) and
    are regrouped by row; the other columns come along as they are."""
    others = [c for c in numbered.columns if c not in ("items", "_row")]
    top = broadcast_if_small(allowed.select("item").distinct().withColumn("ok", F.lit(True)))
    items = numbered.select("_row", *others, F.explode_outer("items").alias("item")).join(top, "item", "left")
    kept = items.groupBy("_row", *others).agg(F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("item")))).alias("items"))
    return kept.select(*numbered.columns)


def min_items_filter(baskets: DataFrame, min_items: int) -> DataFrame:
    """Distinct sorted items; keep baskets with at least ``min_items``."""
    return baskets.withColumn("items", F.array_sort(F.array_distinct("items"))).filter(
        F.size("items") >= min_items
    )


def load_baskets(baskets: DataFrame, max_baskets: int | None = None, start_date: str | None = None,
                 end_date: str | None = None, top_items_n: int | None = None, min_items: int = 2,
                 pad_width: int | None = 10) -> DataFrame:
    """All of the above as one call; returns ``(transaction_id, t_dat, items)``."""
    b = date_filter(baskets.select("transaction_id", "customer_id", "t_dat", "items"), start_date, end_date)
    b = first_n(b, max_baskets)
    b = with_parsed_items(b, "items", pad_width)
    if top_items_n:
        b = _numbered(b)  # read twice: for the counts and for the restriction
        b = _restricted(b, top_items(b, top_items_n))
    return min_items_filter(b, min_items).select("transaction_id", "t_dat", "items")


def basket_stats(transactions: DataFrame, raise_on_empty: bool = False) -> DataFrame:
    """Transaction count and unique items in one pass (HLL is not used: the
    distinct count is exact)."""
    spark = transactions.sparkSession
    n = transactions.select(F.count(F.lit(1)).alias("n")).scalar()
    # distinct items: the explode is partially de-duplicated per task before
    # the shuffle on ``item``, so a hot item costs one row per task
    unique = transactions.select(F.explode("items").alias("item")).agg(F.count_distinct("item").alias("u")).scalar()
    out = spark.range(1).select(n.alias("transactions"), unique.alias("unique_items"))
    if raise_on_empty and out.first()["transactions"] == 0:
        raise ValueError("No transactions left after filtering.")
    return out


def basket_incidence(transactions: DataFrame) -> DataFrame:
    """Sparse basket x item incidence as a long table (one row per present cell)."""
    return transactions.select("transaction_id", F.explode(F.array_distinct("items")).alias("item"))


def item_vocabulary(transactions: DataFrame) -> DataFrame:
    """``(item, idx)``: every item there is, numbered from 0 in item order
    (no cut; the numbers come from a range partition, not from one task)."""
    items = transactions.select(F.explode("items").alias("item")).filter(F.col("item").isNotNull()).distinct()
    return dense_ids(items, ["item"], "idx").withColumn("idx", (F.col("idx") - 1).cast("int"))


def incidence_vectors(transactions: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """The binary basket x item matrix by rows, as sparse vectors: the
    columns of ``transactions`` without ``items``, then ``size`` (items in the
    vocabulary, counted), ``indices`` (ascending) and ``values`` (all 1).

    A row is a basket, whatever its id.  Items outside a given ``vocabulary``
    are left out; a basket without any has an empty vector."""
    rows = _numbered(transactions)
    words = cut_lineage(item_vocabulary(rows) if vocabulary is None else vocabulary.select("item", "idx"))
    size = words.count()
    others = [c for c in transactions.columns if c != "items"]
    cells = rows.select("_row", *others, F.explode_outer("items").alias("item")).join(
        broadcast_if_small(words, known_rows=size), "item", "left")
    # a row's cells and its other columns together: one shuffle by row
    gathered = cells.groupBy("_row", *others).agg(F.sort_array(F.collect_set("idx")).alias("indices"))
    return gathered.select(*others, F.lit(size).alias("size"), "indices",
                           F.transform("indices", lambda i: F.lit(1.0)).alias("values"))
