"""Queries for sources, cleaning and basket building (S1, S2, P1-P11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import prep
from tillroll.plans.registry import query
from tillroll.plans.sql import ARTICLES, ARTICLES_WIDE, BASKETS, CUSTOMERS, TX, with_, zfill
from tillroll.sources import tables

MIN_ITEMS = 2
HEAD_ROWS = 10_000


@query("scan_transactions", with_(TX) + "SELECT t_dat, customer_id, article_id FROM tx")
def scan_transactions(spark, sf_dir):
    return tables.transactions(spark, sf_dir)


@query("reduce_articles", with_(ARTICLES) + f"""
SELECT {zfill('article_id')} AS article_id, prod_name, product_type_name, product_group_name,
       department_name, section_name, garment_group_name FROM articles""")
def reduce_articles(spark, sf_dir):
    return tables.padded_articles(spark, sf_dir)


@query("normalize_article_id", with_(TX) + f"""
SELECT DISTINCT article_id AS raw_article_id, {zfill('article_id')} AS article_id FROM tx""")
def normalize_article_id(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir).select(F.col("article_id").alias("raw_article_id"), "article_id")
    return prep.normalize_article_id(tx.distinct())


@query("dedupe_transactions", with_(TX) + f"""
SELECT DISTINCT t_dat, customer_id, {zfill('article_id')} AS article_id FROM tx
WHERE t_dat IS NOT NULL AND customer_id IS NOT NULL AND article_id IS NOT NULL""")
def dedupe_transactions(spark, sf_dir):
    return prep.dedupe_transactions(tables.transactions(spark, sf_dir))


@query("head_transactions", with_(TX) + f"""
SELECT t_dat, customer_id, article_id FROM tx ORDER BY t_dat, customer_id, article_id LIMIT {HEAD_ROWS}""")
def head_transactions(spark, sf_dir):
    return prep.head_transactions(tables.transactions(spark, sf_dir), HEAD_ROWS)


@query("build_baskets", with_(TX, BASKETS) + """
SELECT transaction_id, customer_id, t_dat, array_to_string(items, ' ') AS items, item_count FROM baskets""")
def build_baskets(spark, sf_dir):
    return prep.baskets_as_text(prep.build_baskets(tables.transactions(spark, sf_dir), MIN_ITEMS))


@query("ingest_counts", with_(TX, BASKETS) + f"""
SELECT (SELECT count(*) FROM tx) AS rows_read,
       (SELECT count(*) FROM (SELECT DISTINCT t_dat, customer_id, {zfill('article_id')} FROM tx
                              WHERE t_dat IS NOT NULL AND customer_id IS NOT NULL AND article_id IS NOT NULL)) AS unique_lines,
       (SELECT count(*) FROM baskets) AS baskets_kept""")
def ingest_counts(spark, sf_dir):
    return prep.ingest_counts(tables.transactions(spark, sf_dir), MIN_ITEMS)


@query("clean_transactions", with_(TX) + """
SELECT DISTINCT CAST(t_dat AS TIMESTAMP) AS t_dat, customer_id, article_id, price, sales_channel_id FROM tx
WHERE t_dat IS NOT NULL AND customer_id IS NOT NULL AND article_id IS NOT NULL""")
def clean_transactions(spark, sf_dir):
    return prep.clean_transactions(tables.transactions_wide(spark, sf_dir))


@query("clean_articles", with_(ARTICLES_WIDE) + f"""
SELECT article_id, f.prod_name, f.product_type_name, f.product_group_name, f.graphical_appearance_name,
       f.colour_group_name, f.department_name, f.section_name, f.garment_group_name, f.detail_desc
FROM (SELECT article_id, min({{'prod_name': prod_name, 'product_type_name': product_type_name,
        'product_group_name': product_group_name, 'graphical_appearance_name': graphical_appearance_name,
        'colour_group_name': colour_group_name, 'department_name': department_name, 'section_name': section_name,
        'garment_group_name': garment_group_name, 'detail_desc': detail_desc}}) AS f
      FROM articles_wide WHERE article_id IS NOT NULL GROUP BY article_id)""")
def clean_articles(spark, sf_dir):
    return prep.clean_articles(tables.articles_wide_raw(spark, sf_dir))


@query("clean_customers", with_(CUSTOMERS) + """
SELECT customer_id, f.age, f.club_member_status, f.fashion_news_frequency
FROM (SELECT customer_id, min({'age': age, 'club_member_status': club_member_status,
        'fashion_news_frequency': fashion_news_frequency}) AS f
      FROM customers WHERE customer_id IS NOT NULL GROUP BY customer_id)""")
def clean_customers(spark, sf_dir):
    return prep.clean_customers(tables.customers_wide(spark, sf_dir))


@query("baskets_by_customer_date", with_(TX) + """
SELECT CAST(row_number() OVER (ORDER BY customer_id, t_dat) AS BIGINT) AS basket_id, customer_id, t_dat,
       array_to_string(items, ' ') AS items
FROM (SELECT customer_id, t_dat, list_sort(list(DISTINCT article_id)) AS items
      FROM (SELECT DISTINCT t_dat, customer_id, article_id, price, sales_channel_id FROM tx
            WHERE t_dat IS NOT NULL AND customer_id IS NOT NULL AND article_id IS NOT NULL)
      GROUP BY customer_id, t_dat)
WHERE len(items) >= 2""")
def baskets_by_customer_date(spark, sf_dir):
    clean = prep.clean_transactions(tables.transactions_wide(spark, sf_dir))
    out = prep.baskets_by_customer_date(clean, MIN_ITEMS)
    return out.withColumn("items", F.array_join("items", " "))
