"""Incremental ingest of purchase lines with key de-duplication (ST1), and
baskets kept up to date with it.

Files are consumed with ``Trigger.AvailableNow``.  The table of unique lines is
partitioned by month and by bucket, a hash of customer and day, and its files
are sorted by day and customer.  A micro-batch is de-duplicated on the line key
and anti-joined against what is stored in the folders that its own keys fall
into, between the first and the last of its days there; what is new is
appended.  So a batch reads in proportion to the folders it touches, not to the
month.  There is no streaming state and no watermark: files may come in any
order, lines of any age are kept, and a replayed batch adds nothing twice.

A basket (customer and day) lies in one folder.  With a basket table given,
the baskets of the folders a batch touches are built again from the stored
lines and replace those folders alone; a batch that is replayed after a
failure between the two steps builds them again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import zfill
from tillroll.operators.prep import LINE_KEY, build_baskets
from tillroll.session import ensure_checkpoint_dir, held

ROWS_PER_WRITER = 1_000_000
BUCKETS = 16  # folders of a month; fixed for the life of a table
FOLDER = ["t_month", "bucket"]
TABLE_SCHEMA = "t_dat string, customer_id string, article_id string, t_month string, bucket int"
BASKETS_SCHEMA = ("transaction_id string, customer_id string, t_dat string, items array<string>, item_count bigint, "
                  "t_month string, bucket int")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def item_stream(spark: SparkSession, lineitem_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The lineitem files as they arrive.  Without ``max_files_per_trigger``
    all files there are make one batch."""
    reader = spark.readStream.schema(spark.read.parquet(lineitem_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(lineitem_path).select("l_orderkey", "l_partkey")


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Purchase lines of lineitem rows joined to their orders."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return items.join(o, items["l_orderkey"] == o["o_orderkey"]).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("t_dat"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        zfill(F.col("l_partkey").cast("string")).alias("article_id"),
    ).na.drop(subset=LINE_KEY)


def with_orders(orders: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """For ``ingest_unique_lines``: a batch of lineitem rows as purchase lines.
    Only orders between the batch's first and last key are read (the range
    reaches the scan), so a batch of new orders does not read the old ones."""

    def lines(batch: DataFrame) -> DataFrame:
        first, last = batch.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
        near = orders.filter(F.col("o_orderkey").between(first, last)) if first is not None else orders.limit(0)
        return order_lines(batch, near)

    return lines


def lines_stream(spark: SparkSession, lineitem_path: str, orders: DataFrame,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming purchase lines: a stream-static equi-join with all orders,
    once per micro-batch."""
    return order_lines(item_stream(spark, lineitem_path, max_files_per_trigger), orders)


def read_unique_lines(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMA).parquet(table_path)


def read_kept_baskets(spark: SparkSession, baskets_path: str) -> DataFrame:
    return spark.read.schema(BASKETS_SCHEMA).parquet(baskets_path)


def _placed(lines: DataFrame, buckets: int) -> DataFrame:
    return lines.withColumns({"t_month": F.substring("t_dat", 1, 7),
                              "bucket": F.pmod(F.xxhash64("customer_id", "t_dat"), F.lit(buckets)).cast("int")})


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _touched(folders: list, days: bool) -> Column:
    """The folders of a batch as a condition on the partition columns; with
    ``days`` also their first and last day, which reaches the files."""
    months: dict[str, list] = {}
    for r in folders:
        months.setdefault(r["t_month"], []).append(r)
    out = []
    for month, rows in sorted(months.items()):
        one = (F.col("t_month") == month) & F.col("bucket").isin([r["bucket"] for r in rows])
        if days:
            one = one & F.col("t_dat").between(min(r["first"] for r in rows), max(r["last"] for r in rows))
        out.append(one)
    return _any(out)


def _sized(df: DataFrame, rows: dict[tuple, int], rows_per_writer: int, salt: Column) -> DataFrame:
    """``df`` dealt to as many writers a folder as it fills; small folders
    share a writer."""
    writers = {k: math.ceil(n / rows_per_writer) for k, n in rows.items()}
    most = F.create_map(*[F.lit(x) for (month, b), n in writers.items() for x in (f"{month}/{b}", n)])
    at = F.pmod(salt, most[F.concat_ws("/", *FOLDER)])
    tasks = min(len(rows), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(max(tasks, math.ceil(sum(rows.values()) / rows_per_writer)), *FOLDER, at)


def _empty_table(spark: SparkSession, schema: str, path: str) -> None:
    """Makes the folder, so that every batch can read the table it adds to."""
    spark.createDataFrame([], schema).write.mode("append").parquet(path)


def ingest_unique_lines(stream: DataFrame, table_path: str, checkpoint_location: str,
                        rows_per_writer: int = ROWS_PER_WRITER, buckets: int = BUCKETS,
                        lines_of: Callable[[DataFrame], DataFrame] | None = None,
                        baskets_path: str | None = None, min_items: int = 2) -> None:
    """Run the stream to completion (available-now) into ``table_path``;
    ``lines_of`` makes the purchase lines of a batch where the stream does not
    hold them.  ``baskets_path``: the baskets of the table, kept up to date."""
    spark = stream.sparkSession
    _empty_table(spark, TABLE_SCHEMA, table_path)
    if baskets_path:
        _empty_table(spark, BASKETS_SCHEMA, baskets_path)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        lines = lines_of(batch) if lines_of else batch
        unique = _placed(lines.select(*LINE_KEY).dropDuplicates(LINE_KEY), buckets)
        with held(unique) as new:
            folders = new.groupBy(*FOLDER).agg(F.count(F.lit(1)).alias("n"), F.min("t_dat").alias("first"),
                                               F.max("t_dat").alias("last")).collect()  # one row per folder
            if not folders:
                return
            session = batch.sparkSession
            stored = read_unique_lines(session, table_path).filter(_touched(folders, days=True))
            fresh = new.join(stored, [*LINE_KEY, *FOLDER], "left_anti")
            rows = {(r["t_month"], r["bucket"]): r["n"] for r in folders}
            _sized(fresh, rows, rows_per_writer, F.xxhash64("t_dat", "customer_id")).sortWithinPartitions(
                *FOLDER, "t_dat", "customer_id").write.mode("append").partitionBy(*FOLDER).parquet(table_path)
            if baskets_path:
                keep_baskets(session, table_path, baskets_path, folders, min_items, rows_per_writer)

    query = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def keep_baskets(spark: SparkSession, table_path: str, baskets_path: str, folders: list, min_items: int = 2,
                 rows_per_writer: int = ROWS_PER_WRITER) -> None:
    """Build the baskets of ``folders`` (rows of month and bucket) again and
    replace those folders of the basket table; the others stay as they are.
    A writer gets the baskets of about ``rows_per_writer`` lines."""
    lines = read_unique_lines(spark, table_path).filter(_touched(folders, days=False))
    month = F.substring("t_dat", 1, 7).alias("t_month")
    # the bucket is a function of customer and day, so it is the same for all lines of a basket
    place = lines.select("customer_id", "t_dat", "bucket").distinct()
    built = build_baskets(lines, min_items).select("*", month).join(place, ["customer_id", "t_dat"])
    stored = {(r["t_month"], r["bucket"]): r["n"]
              for r in lines.groupBy(*FOLDER).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per folder
    built = built.select("transaction_id", "customer_id", "t_dat", "items", "item_count", *FOLDER)
    (_sized(built, stored, rows_per_writer, F.xxhash64("t_dat", "customer_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*FOLDER).parquet(baskets_path))
