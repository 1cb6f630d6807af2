"""Cleaning and basket building (raw lines -> unique lines -> baskets)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.text import zfill
from tillroll.operators.selection import first_rows
from tillroll.session import broadcast_if_small, cut_lineage

LINE_KEY = ["t_dat", "customer_id", "article_id"]
BASKET_KEY = ["customer_id", "t_dat"]


def normalize_article_id(df: DataFrame, column: str = "article_id") -> DataFrame:
    """Zero-pad an id column in place (never shortens)."""
    return df.withColumn(column, zfill(column))


def dedupe_transactions(lines: DataFrame) -> DataFrame:
    """Unique purchase lines on the 3-column key; lines with a null key part
    are dropped.  One shuffle on the full key (map-side partial distinct)."""
    return normalize_article_id(lines.select(*LINE_KEY)).na.drop(subset=LINE_KEY).dropDuplicates(LINE_KEY)


def head_transactions(lines: DataFrame, max_rows: int) -> DataFrame:
    """First ``max_rows`` lines in key order (total order, so the result does
    not depend on file splits)."""
    return first_rows(lines.select(*LINE_KEY), max_rows, LINE_KEY)


def build_baskets(lines: DataFrame, min_items: int = 2) -> DataFrame:
    """One basket per (customer, day): sorted distinct padded items.

    Dedupe and grouping share one shuffle on ``(customer_id, t_dat)``:
    ``collect_set`` is partially aggregated map-side, so even a customer-day
    holding a third of all lines ships at most its distinct articles per map
    task, and the final set is bounded by the article catalogue.
    """
    clean = lines.select(
        "customer_id", "t_dat", zfill("article_id").alias("article_id")
    ).na.drop(subset=LINE_KEY)
    grouped = clean.groupBy(*BASKET_KEY).agg(F.array_sort(F.collect_set("article_id")).alias("items"))
    return grouped.select(
        F.concat_ws("_", "customer_id", "t_dat").alias("transaction_id"),
        "customer_id",
        "t_dat",
        "items",
        F.size("items").cast("bigint").alias("item_count"),
    ).filter(F.col("item_count") >= min_items)


def baskets_as_text(baskets: DataFrame) -> DataFrame:
    """Sink shape: items joined by one blank."""
    return baskets.withColumn("items", F.array_join("items", " "))


def ingest_counts(lines: DataFrame, min_items: int = 2) -> DataFrame:
    """Lines read, unique lines, baskets kept, as one row, in one pass.

    Lines are grouped per (customer, day), null keys included, so that the
    same groups give all three counts; the sets are aggregated map-side."""
    whole = F.col("customer_id").isNotNull() & F.col("t_dat").isNotNull()
    groups = lines.select(*BASKET_KEY, zfill("article_id").alias("article_id")).groupBy(*BASKET_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.size(F.collect_set("article_id")).alias("items"))
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        F.coalesce(F.sum("n"), zero).alias("rows_read"),
        F.coalesce(F.sum(F.when(whole, F.col("items"))), zero).alias("unique_lines"),
        F.count_if(whole & (F.col("items") >= min_items)).alias("baskets_kept"))


def clean_transactions(lines_wide: DataFrame) -> DataFrame:
    """Project 5 columns, parse the day, drop null keys, drop full duplicates."""
    out = lines_wide.select(
        F.to_timestamp_ntz(F.col("t_dat")).alias("t_dat"),
        "customer_id",
        "article_id",
        "price",
        "sales_channel_id",
    ).na.drop(subset=LINE_KEY)
    return out.distinct()


def keep_first_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Drop null keys and keep one row per key: the smallest by the remaining
    columns.  ``min(struct)`` aggregates partially map-side, so a key repeated
    in a third of all rows never lands whole in one task (a window would)."""
    others = [c for c in columns if c != key]
    picked = df.select(*columns).na.drop(subset=[key]).groupBy(key).agg(F.min(F.struct(*others)).alias("_first"))
    return picked.select(key, *[F.col(f"_first.{c}").alias(c) for c in others])


# Columns of the clean tables.
ARTICLE_WIDE_COLUMNS = [
    "article_id", "prod_name", "product_type_name", "product_group_name", "graphical_appearance_name",
    "colour_group_name", "department_name", "section_name", "garment_group_name", "detail_desc",
]
CUSTOMER_WIDE_COLUMNS = ["customer_id", "age", "club_member_status", "fashion_news_frequency"]


def clean_articles(articles_wide: DataFrame) -> DataFrame:
    return keep_first_per_key(articles_wide, "article_id", ARTICLE_WIDE_COLUMNS)


def clean_customers(customers_wide: DataFrame) -> DataFrame:
    return keep_first_per_key(customers_wide, "customer_id", CUSTOMER_WIDE_COLUMNS)


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str, num_partitions: int | None = None) -> DataFrame:
    """Dense ids 1..n in ``order_cols`` order without a single-partition window.

    Range-partition and sort inside partitions (as many as the session's
    shuffles have, unless given), number rows inside each partition, then add
    the number of rows of all earlier partitions (a table with one row per
    partition).  The partitioned frame is written to shared storage so both
    passes see the same split.
    """
    by = [num_partitions] if num_partitions else []
    staged = cut_lineage(
        df.repartitionByRange(*by, *order_cols).sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id = (partition << 33) + row index in partition
    pid = F.shiftright("_mid", 33)
    sizes = staged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    out = staged.withColumn("_pid", pid).join(broadcast_if_small(offsets), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return out.withColumn(id_col, (F.col("_off") + local + 1).cast("bigint")).drop("_pid", "_mid", "_off")


def baskets_by_customer_date(clean_lines: DataFrame, min_items: int = 2) -> DataFrame:
    """Legacy basket table: distinct (unpadded) items per customer and day,
    at least ``min_items``, dense ``basket_id`` from 1 in (customer, day) order."""
    grouped = (
        clean_lines.groupBy("customer_id", F.date_format("t_dat", "yyyy-MM-dd").alias("t_dat"))
        .agg(F.array_sort(F.collect_set("article_id")).alias("items"))
        .filter(F.size("items") >= min_items)
    )
    with_ids = dense_ids(grouped, ["customer_id", "t_dat"], "basket_id")
    return with_ids.select("basket_id", "customer_id", "t_dat", "items")
