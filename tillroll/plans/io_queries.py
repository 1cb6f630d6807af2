"""Round trips through the sinks and the streaming ingest (S5-S9, S19, ST1)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tillroll.operators import baskets as B
from tillroll.operators import compare, experiments, mining, prep, variants
from tillroll.plans import sql as S
from tillroll.plans.inputs import basket_arrays, mining_baskets, product_group_baskets
from tillroll.plans.registry import query
from tillroll.session import cut_lineage, held
from tillroll.sources import files, tables
from tillroll.streaming import ingest

SUPPORT = 0.01
FOLDERS_A_MONTH = 2  # the given tables have few lines a month
LINES_A_FILE = 1_000_000  # so no task writes or streams a share of the whole table


def _inbox(spark, sf_dir, name, batches, order):
    """Deal the lines out to files in the order of their keys; returns the
    folder and how many of its files make one of ``batches`` batches."""
    inbox = ingest.scratch_path(spark, name)
    lines = tables.table(spark, sf_dir, "lineitem")
    a_batch = max(1, math.ceil(lines.count() / (batches * LINES_A_FILE)))
    # the line number splits an order that fills more than a file
    lines.repartitionByRange(batches * a_batch, order, "l_linenumber").write.parquet(inbox)
    return inbox, a_batch


@query("incremental_dedupe", S.with_(S.TX) + f"""
SELECT DISTINCT t_dat, customer_id, {S.zfill('article_id')} AS article_id FROM tx
WHERE t_dat IS NOT NULL AND customer_id IS NOT NULL AND article_id IS NOT NULL""")
def incremental_dedupe(spark, sf_dir):
    """Deal the lines out to files, newest orders first, stream them in four
    batches through the key de-duplication, and read the table."""
    inbox, files_a_batch = _inbox(spark, sf_dir, "line-files", 4, F.desc("l_orderkey"))
    table_path = ingest.scratch_path(spark, "unique-lines")
    ingest.ingest_unique_lines(
        ingest.item_stream(spark, inbox, max_files_per_trigger=files_a_batch), table_path,
        ingest.scratch_path(spark, "unique-lines-ckpt"), buckets=FOLDERS_A_MONTH,
        lines_of=ingest.with_orders(tables.table(spark, sf_dir, "orders")))
    return ingest.read_unique_lines(spark, table_path).select("t_dat", "customer_id", "article_id")


@query("incremental_baskets", S.with_(S.TX, S.BASKETS) + """
SELECT transaction_id, customer_id, t_dat, array_to_string(items, ' ') AS items, item_count FROM baskets""")
def incremental_baskets(spark, sf_dir):
    """The lines in two chunks, and the baskets that the ingest keeps."""
    inbox, files_a_batch = _inbox(spark, sf_dir, "basket-files", 2, F.col("l_orderkey"))
    baskets_path = ingest.scratch_path(spark, "kept-baskets")
    ingest.ingest_unique_lines(
        ingest.item_stream(spark, inbox, max_files_per_trigger=files_a_batch), ingest.scratch_path(spark, "basket-lines"),
        ingest.scratch_path(spark, "basket-ckpt"), buckets=FOLDERS_A_MONTH,
        lines_of=ingest.with_orders(tables.table(spark, sf_dir, "orders")), baskets_path=baskets_path)
    return ingest.read_kept_baskets(spark, baskets_path).select(
        "transaction_id", "customer_id", "t_dat", F.array_join("items", " ").alias("items"), "item_count")


@query("baskets_roundtrip", S.with_(S.TX, S.BASKETS) + """
SELECT transaction_id, customer_id, t_dat, array_to_string(items, ' ') AS items, item_count, fmt
FROM baskets, (VALUES ('parquet'), ('csv')) AS f(fmt)""")
def baskets_roundtrip(spark, sf_dir):
    """Write the baskets in both formats and read all of them back."""
    baskets = cut_lineage(basket_arrays(spark, sf_dir))
    parts = []
    for fmt in ("parquet", "csv"):
        path = ingest.scratch_path(spark, f"baskets-{fmt}")
        files.write_baskets(baskets, path, fmt)
        back = files.read_baskets(spark, path, fmt)
        items = F.col("items") if fmt == "csv" else F.array_join("items", " ")
        parts.append(back.select("transaction_id", "customer_id", "t_dat", items.alias("items"), "item_count",
                                 F.lit(fmt).alias("fmt")))
    return parts[0].unionByName(parts[1])


@query("itemsets_roundtrip", S.mining_with(*S.itemsets_upto3(SUPPORT)) + """
SELECT support, itemset_key, length, support_count FROM itemsets""")
def itemsets_roundtrip(spark, sf_dir):
    """Write the itemset file and read it back."""
    path = ingest.scratch_path(spark, "itemsets")
    files.write_itemsets(mining.apriori(mining_baskets(spark, sf_dir), SUPPORT, 3), path)
    return spark.read.schema("support double, itemset_key string, length int, support_count bigint").option(
        "header", True).csv(path)


@query("variants_roundtrip", S.with_(S.TX, S.BASKETS, S.YEAR_RANGES) + """
SELECT r.variant, b.transaction_id, array_to_string(b.items, ' ') AS items
FROM baskets b JOIN year_ranges r ON b.t_dat >= r.start_day AND b.t_dat <= r.end_day WHERE b.item_count >= 2""")
def variants_roundtrip(spark, sf_dir):
    """Write the year variants, a folder each, and read them back."""
    path = ingest.scratch_path(spark, "variants")
    files.write_variants(variants.year_baskets(basket_arrays(spark, sf_dir)), path)
    return spark.read.parquet(path).select("variant", "transaction_id", F.array_join("items", " ").alias("items"))


@query("profile_roundtrip", S.with_(S.TX) + """
SELECT count(*) AS rows, count(*) FILTER (WHERE article_id IS NULL) AS null_articles, min(t_dat) AS first_day,
       max(t_dat) AS last_day FROM tx""")
def profile_roundtrip(spark, sf_dir):
    """Write a profile of the lines as JSON and read it back."""
    path = ingest.scratch_path(spark, "profile")
    lines = tables.transactions(spark, sf_dir)
    files.write_json(lines.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("article_id").isNull()).alias("null_articles"),
        F.min("t_dat").alias("first_day"), F.max("t_dat").alias("last_day")), path)
    return spark.read.schema("rows bigint, null_articles bigint, first_day string, last_day string").json(path)


@query("summary_roundtrip", S.mining_with(*S.itemsets_upto3(SUPPORT, max_len=2)) + f"""
SELECT algorithm, (SELECT count(*) FROM mining_baskets) AS transactions,
       (SELECT count(DISTINCT item) FROM mining_items) AS unique_items, CAST({SUPPORT} AS DOUBLE) AS min_support,
       (SELECT count(*) FROM itemsets) AS frequent_itemsets, (SELECT max(length) FROM itemsets) AS max_itemset_length,
       (SELECT count(*) FROM itemsets) AS common_itemsets, 0 AS only_left, 0 AS only_right
FROM (VALUES ('apriori'), ('eclat')) AS m(algorithm)""")
def summary_roundtrip(spark, sf_dir):
    """One run's nested summary as JSON, read back and laid out by method."""
    path = ingest.scratch_path(spark, "summary")
    with held(mining_baskets(spark, sf_dir)) as b:
        found, seconds = experiments.run_methods(b, SUPPORT, 2, ("apriori", "eclat"))
        long = compare.method_long(found)
        files.append_summary(files.run_summary(
            {"min_support": SUPPORT, "max_len": 2, "max_baskets": None},
            experiments.method_summary(found, B.basket_stats(b), seconds), compare.common_itemsets(long, list(found)),
            compare.pairwise_differences(long, list(found))), path)
    part = "struct<frequent_itemsets:bigint,max_itemset_length:int>"
    back = spark.read.schema(
        "input struct<parameters:struct<min_support:double>,transactions:bigint,unique_items:bigint>, "
        f"algorithms map<string,{part}>, comparison struct<common_itemsets:bigint,"
        "pairwise_differences:map<string,struct<only_left:bigint,only_right:bigint>>>").json(path)
    pair = F.col("comparison.pairwise_differences")["apriori_vs_eclat"]
    return back.select("input", "comparison", pair.alias("pair"), F.explode("algorithms").alias("algorithm", "a")).select(
        "algorithm", "input.transactions", "input.unique_items", "input.parameters.min_support", "a.frequent_itemsets",
        "a.max_itemset_length", "comparison.common_itemsets", "pair.only_left", "pair.only_right")


@query("experiments_roundtrip", S.mining_with(*S.itemsets_upto3(SUPPORT)) + " UNION ALL ".join(
    f"""SELECT '{c}' AS config, '{m}' AS algorithm, (SELECT count(*) FROM itemsets WHERE length <= {n})
          AS frequent_itemsets, CAST({n} AS INTEGER) AS max_len, 'ok' AS status"""
    for c, n in (("pairs", 2), ("triples", 3)) for m in ("apriori", "eclat")))
def experiments_roundtrip(spark, sf_dir):
    """Two configs, each added to the experiment log when it is done, and the
    log read back."""
    path = ingest.scratch_path(spark, "experiments")
    text = cut_lineage(prep.baskets_as_text(product_group_baskets(spark, sf_dir)))
    base = dict(max_baskets=0, top_items=0, min_support=SUPPORT)
    experiments.experiment_grid(text, [dict(name="pairs", max_len=2), dict(name="triples", max_len=3)], base,
                                ("apriori", "eclat"), sink=path)
    return files.read_experiments(spark, path).select("config", "algorithm", "frequent_itemsets", "max_len", "status")
