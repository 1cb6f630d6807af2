"""Shared Spark inputs of the registered queries (all derived from the
driver tables, in full)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import baskets as B
from tillroll.operators import prep, variants
from tillroll.sources import tables

MIN_ITEMS = 2


def basket_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.build_baskets(tables.transactions(spark, sf_dir), MIN_ITEMS)


def basket_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets as stored by the basket sink (items joined by blanks)."""
    return prep.baskets_as_text(basket_arrays(spark, sf_dir))


def category_arrays(spark: SparkSession, sf_dir: str, column: str, prefix: str) -> DataFrame:
    arts = tables.articles_raw(spark, sf_dir)
    m = variants.article_category_map(arts, column, prefix)
    return variants.category_baskets(basket_arrays(spark, sf_dir), m, MIN_ITEMS, map_rows=arts.count())


def product_group_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_arrays(spark, sf_dir, "product_group_name", "product_group")


def mining_text_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loading chain from the stored text form (parse -> distinct -> size)."""
    return B.load_baskets(prep.baskets_as_text(product_group_baskets(spark, sf_dir)), min_items=MIN_ITEMS)


def mining_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mining input: product-group baskets loaded whole (no basket or item
    cut).  They stay arrays: the stored text form would be parsed back to the
    same already-padded tokens, so the text round trip is skipped."""
    return B.load_baskets(product_group_baskets(spark, sf_dir), min_items=MIN_ITEMS)


def garment_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-mining input: garment-group roll-up (few categories, so rules
    with several consequents exist), loaded whole."""
    return B.load_baskets(category_arrays(spark, sf_dir, "garment_group_name", "garment_group"),
                          min_items=MIN_ITEMS)


def article_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.padded_articles(spark, sf_dir).select("article_id", "prod_name")
