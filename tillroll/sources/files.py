"""File sources and sinks with explicit schemas (CSV / JSON / Parquet).

Sinks write whole tables in one Spark job each; nothing is appended row by
row from the driver except the run log, whose rows are a few per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File headers and run-log columns.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("t_dat", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("article_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("sales_channel_id", T.IntegerType()),
])
ARTICLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [
    "article_id", "prod_name", "product_type_name", "product_group_name", "graphical_appearance_name",
    "colour_group_name", "department_name", "section_name", "garment_group_name", "detail_desc"]])
CUSTOMER_SCHEMA = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("age", T.DoubleType()),
                                T.StructField("club_member_status", T.StringType()),
                                T.StructField("fashion_news_frequency", T.StringType())])
BASKET_SCHEMA = "transaction_id string, customer_id string, t_dat string, items string, item_count bigint"
EXPERIMENT_SCHEMA = T.StructType([
    T.StructField("config", T.StringType()), T.StructField("algorithm", T.StringType()),
    T.StructField("elapsed_seconds", T.DoubleType()), T.StructField("fastest", T.BooleanType()),
    T.StructField("frequent_itemsets", T.LongType()), T.StructField("max_itemset_length", T.IntegerType()),
    T.StructField("transactions", T.LongType()), T.StructField("unique_items", T.LongType()),
    T.StructField("max_baskets", T.LongType()), T.StructField("top_items", T.LongType()),
    T.StructField("min_support", T.DoubleType()), T.StructField("max_len", T.IntegerType()),
    T.StructField("common_itemsets", T.LongType()), T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType())])
CATALOG_SCHEMA = "rank int, old_article_idx int, new_item_idx int"
METRIC_SCHEMA = ("Model string, Loss double, `Accuracy (Top-1)` double, `Top-3 Accuracy` double, "
                 "`Top-5 Accuracy` double, `Top-10 Accuracy` double, `Top-20 Accuracy` double")
RUN_LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [
    "run_id", "created_at", "preset", "basket_dataset", "algorithm", "elapsed_seconds", "peak_memory_mb",
    "frequent_itemsets", "max_itemset_length", "transactions", "unique_items", "max_baskets", "top_items",
    "min_items", "min_support", "max_len", "date_range", "start_date", "end_date", "output"]])


def read_transactions_csv(spark: SparkSession, path: str, columns=("t_dat", "customer_id", "article_id")) -> DataFrame:
    """Transaction lines from CSV with a fixed schema; only ``columns`` are
    kept (a projection Catalyst pushes into the scan)."""
    return spark.read.schema(TRANSACTION_SCHEMA).option("header", True).csv(path).select(*columns)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by the names in the file's header (in any order;
    a column the file lacks is null)."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    have = {c.strip().lower(): c for c in raw.columns}
    return raw.select(*[(F.col(f"`{have[f.name]}`") if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
                        for f in schema])


def read_articles_csv(spark: SparkSession, path: str) -> DataFrame:
    """The article columns in use out of a wider file."""
    return _read_csv(spark, path, ARTICLE_SCHEMA)


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Customers; an age that is no number is null."""
    return _read_csv(spark, path, CUSTOMER_SCHEMA)


def write_baskets(baskets: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Baskets partitioned by year of the day, so a date filter on read
    prunes whole folders; CSV keeps the items as one blank-joined column."""
    out = baskets.withColumn("t_year", F.substring("t_dat", 1, 4))
    if fmt == "csv":
        out = out.withColumn("items", F.array_join("items", " "))
        out.write.mode("overwrite").partitionBy("t_year").option("header", True).csv(path)
    else:
        out.write.mode("overwrite").partitionBy("t_year").parquet(path)


def read_baskets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Baskets of either format; CSV items stay text (``load_baskets`` parses)."""
    if fmt == "csv":
        return spark.read.schema(f"{BASKET_SCHEMA}, t_year string").option("header", True).csv(path)
    return spark.read.parquet(path)


def write_itemsets(itemsets: DataFrame, path: str) -> None:
    """Itemsets with their key and product names, as CSV."""
    itemsets.select("support", "itemset_key", "length", "support_count",
                    *[c for c in ("product_names",) if c in itemsets.columns]
                    ).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Result tables (summaries, manifests, profiles) as JSON lines, written
    by as many tasks as the table has."""
    df.write.mode("overwrite").json(path)


def run_summary(config: dict, methods: DataFrame, common: DataFrame, pairs: DataFrame) -> DataFrame:
    """One run as one nested row: ``input`` (the run's parameters with the
    basket and item counts), ``algorithms`` (by name: seconds where measured,
    itemsets, longest length) and ``comparison`` (common itemsets and, for each
    pair of methods, what only one of them has).

    ``methods`` as ``experiments.method_summary`` gives them, ``common`` and
    ``pairs`` as ``compare`` does: a row a method or pair, so the gathered maps
    are as short as the lists of methods."""
    given = F.struct(*[F.lit(v).cast("string" if v is None else "bigint" if type(v) is int else "double" if type(v) is float
                                     else "string").alias(k) for k, v in config.items()])
    seconds = [F.round("elapsed_seconds", 4).alias("elapsed_seconds")] if "elapsed_seconds" in methods.columns else []
    each = F.struct(*seconds, "frequent_itemsets", "max_itemset_length")
    by_method = methods.agg(F.max("transactions").alias("transactions"), F.max("unique_items").alias("unique_items"),
                            F.map_from_entries(F.sort_array(F.collect_list(F.struct("algorithm", each.alias("v"))))
                                               ).alias("algorithms"))
    side = F.struct("only_left", "only_right").alias("v")
    by_pair = pairs.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("pair", side)))).alias("pairwise_differences"))
    one = by_method.agg(F.first(F.struct("*")).alias("m")).select(
        "m", common.agg(F.first("common_itemsets")).scalar().alias("c"),
        by_pair.agg(F.first("pairwise_differences")).scalar().alias("p"))
    return one.select(
        F.struct(given.alias("parameters"), F.col("m.transactions").alias("transactions"),
                 F.col("m.unique_items").alias("unique_items")).alias("input"),
        F.col("m.algorithms").alias("algorithms"),
        F.struct(F.col("c").alias("common_itemsets"), F.col("p").alias("pairwise_differences")).alias("comparison"))


def append_summary(summary: DataFrame, path: str) -> None:
    """Add one run's summary: one JSON object on a line of its own."""
    summary.coalesce(1).write.mode("append").option("ignoreNullFields", False).json(path)


def write_experiment(rows: DataFrame, path: str) -> None:
    """Add one config's rows to the experiment log (CSV, a folder a config)."""
    rows.write.mode("append").partitionBy("config").option("header", True).csv(path)


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    """The summary over all configs written so far."""
    return spark.read.schema(EXPERIMENT_SCHEMA).option("header", True).csv(path)


def write_variants(variants: DataFrame, path: str) -> None:
    """All variants in one overwrite, one folder per variant."""
    variants.write.mode("overwrite").partitionBy("variant").parquet(path)


def append_run_log(runs: DataFrame, path: str) -> None:
    """Append one run's rows (one per method) to the run log table."""
    runs.select([F.col(f.name).cast("string").alias(f.name) for f in RUN_LOG_SCHEMA.fields]).write.mode(
        "append").parquet(path)


def latest_runs(spark: SparkSession, path: str, limit: int = 30) -> DataFrame:
    """The newest ``limit`` rows, newest first (run id, then creation time)."""
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    return log.orderBy(F.desc("run_id"), F.desc("created_at"), F.asc("algorithm")).limit(limit)


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG_SCHEMA).option("header", True).csv(path)


def read_metric_table(spark: SparkSession, path: str) -> DataFrame:
    """Model metric CSV renamed to the engine's column names."""
    raw = spark.read.schema(METRIC_SCHEMA).option("header", True).csv(path)
    return raw.select(
        F.col("Model").alias("model"), F.col("Loss").alias("loss"), F.col("`Accuracy (Top-1)`").alias("top1"),
        F.col("`Top-3 Accuracy`").alias("top3"), F.col("`Top-5 Accuracy`").alias("top5"),
        F.col("`Top-10 Accuracy`").alias("top10"), F.col("`Top-20 Accuracy`").alias("top20"))
