"""Input views over the driver tables, in the shape the pipeline reads.

Only the columns each view needs are selected, so Parquet scans carry a
pruned ``ReadSchema``; filters written later on these views are pushed into
the scans by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import zfill


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx``: one row per purchase line (day text, customer, article, price,
    channel).  ``article_id`` is deliberately left unpadded; ``l_orderkey``
    and ``l_linenumber`` are kept for sequence ordering.

    lineitem x orders is a large-large equi-join on the order key: Spark
    shuffles both sides on ``o_orderkey`` (sort-merge); AQE splits a hot key.
    """
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("t_dat"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("article_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").cast("int").alias("sales_channel_id"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").alias("order_ts"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow transaction view ``(t_dat, customer_id, article_id)``."""
    return purchase_lines(spark, sf_dir).select("t_dat", "customer_id", "article_id")


def transactions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide view with price and channel, day kept as text."""
    return purchase_lines(spark, sf_dir).select("t_dat", "customer_id", "article_id", "price", "sales_channel_id")


def articles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article dimension (minimal 7 columns), article id unpadded."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("article_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("product_type_name"),
        F.col("p_brand").alias("product_group_name"),
        F.concat_ws(" ", "p_brand", "p_type").alias("department_name"),
        F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("section_name"),
        F.col("p_type").alias("garment_group_name"),
    )


def articles_wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide article dimension: the 7 columns plus appearance, colour and
    description (colour = first word of the part name)."""
    part = table(spark, sf_dir, "part")
    return articles_raw(spark, sf_dir).join(
        part.select(
            F.col("p_partkey").cast("string").alias("article_id"),
            F.col("p_type").alias("graphical_appearance_name"),
            F.split("p_name", " ").getItem(0).alias("colour_group_name"),
            F.col("p_name").alias("detail_desc"),
        ),
        "article_id",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension; the driver table has no age, so it is derived
    (every 17th customer has none)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(F.col("c_custkey") % 17 == 0, F.lit(None).cast("double"))
        .otherwise((F.lit(16) + F.col("c_custkey") % 60).cast("double"))
        .alias("age"),
        F.col("c_mktsegment").alias("club_member_status"),
    )


def customers_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return customers(spark, sf_dir).join(
        c.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.when(F.col("c_acctbal") >= 0, F.lit("Regularly")).otherwise(F.lit("NONE")).alias("fashion_news_frequency"),
        ),
        "customer_id",
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as purchase-like lines: user x day x event type."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("t_dat"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("article_id"),
    )


def padded_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles_raw(spark, sf_dir)
    return a.withColumn("article_id", zfill("article_id"))
