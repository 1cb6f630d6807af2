"""Benchmark tables: several methods on the same baskets, parameter grids.

Seconds are taken around each method's job (a miner writes its result) and
kept beside the result tables, which stay the same from run to run.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import baskets as B
from tillroll.operators import compare
from tillroll.operators.mining import METHODS, mine
from tillroll.session import cut_lineage, held
from tillroll.sources.files import EXPERIMENT_SCHEMA, write_experiment

DEFAULT_CONFIG = dict(max_baskets=50_000, top_items=500, min_items=2, min_support=0.01, max_len=3,
                      start_date=None, end_date=None)


def build_args(base: dict, config: dict) -> dict:
    """Missing keys fall back to the base (then the defaults)."""
    out = dict(DEFAULT_CONFIG)
    out.update({k: v for k, v in base.items() if v is not None})
    out.update({k: v for k, v in config.items() if k != "name"})
    return out


def run_methods(transactions: DataFrame, min_support: float, max_len: int,
                methods=tuple(METHODS)) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """Itemsets and seconds of each method on the same baskets, which the
    caller holds in a cache (``session.held``)."""
    found, seconds = {}, {}
    for name in methods:
        t0 = time.perf_counter()
        found[name] = mine(transactions, min_support, max_len, name)
        seconds[name] = time.perf_counter() - t0
    return found, seconds


def fastest(seconds: dict[str, float]) -> str:
    """The method with the fewest seconds; ties by name."""
    return min(seconds, key=lambda m: (seconds[m], m))


def method_summary(results: dict[str, DataFrame], stats: DataFrame, seconds: dict[str, float] | None = None) -> DataFrame:
    """One row per method: itemsets, longest length (0 when empty), input
    size, and with ``seconds`` the method's time and whether it is the fastest."""
    long = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("algorithm"), "length") for name, df in results.items()])
    # every method has a row, also one that found nothing
    names = stats.select("transactions", "unique_items", F.explode(F.array(*map(F.lit, results))).alias("algorithm"))
    counts = long.groupBy("algorithm").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"))
    out = names.join(counts, "algorithm", "left").select(
        "algorithm", F.coalesce("n", F.lit(0)).alias("frequent_itemsets"),
        F.coalesce("longest", F.lit(0)).alias("max_itemset_length"), "transactions", "unique_items")
    if seconds is not None:
        took = F.create_map(*[F.lit(x) for m in seconds for x in (m, float(seconds[m]))])
        out = out.withColumn("elapsed_seconds", took[F.col("algorithm")]).withColumn(
            "fastest", F.col("algorithm") == fastest(seconds))
    return out


def _parameters(args: dict) -> list:
    """The parameters as given: 0 means "all"."""
    return [F.lit(int(args["max_baskets"] or 0)).cast("bigint").alias("max_baskets"),
            F.lit(int(args["top_items"] or 0)).cast("bigint").alias("top_items"),
            F.lit(float(args["min_support"])).alias("min_support"), F.lit(int(args["max_len"])).alias("max_len"),
            F.lit(args["start_date"]).cast("string").alias("start_date"),
            F.lit(args["end_date"]).cast("string").alias("end_date")]


def _run_config(baskets_text: DataFrame, name: str, args: dict, methods) -> DataFrame:
    tx = B.load_baskets(baskets_text, args["max_baskets"], args["start_date"], args["end_date"], args["top_items"],
                        args["min_items"])
    with held(tx) as tx:
        stats = cut_lineage(B.basket_stats(tx, raise_on_empty=True))
        results, seconds = run_methods(tx, args["min_support"], args["max_len"], methods)
    common = compare.common_itemsets(compare.method_long(results), list(results)).scalar()
    return method_summary(results, stats, seconds).select(
        F.lit(name).alias("config"), "*", *_parameters(args), common.alias("common_itemsets"),
        F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))


def _error_row(spark, name: str, args: dict, error: Exception) -> DataFrame:
    """One row with the config's own parameters and the whole error text."""
    return spark.range(1).select(F.lit(name).alias("config"), *_parameters(args), F.lit("error").alias("status"),
                                 F.lit(str(error)).alias("error"))


def experiment_grid(baskets_text: DataFrame, configs: list[dict], base: dict | None = None, methods=tuple(METHODS),
                    continue_on_error: bool = False, sink: str | None = None, timed: bool = False) -> DataFrame:
    """One row per (config, method).  A failing config yields one row with
    ``status = 'error'``; the loop stops there unless ``continue_on_error``.
    Every config's rows go to ``sink`` (if given) as soon as it is done;
    ``timed`` keeps the seconds in the result."""
    spark = baskets_text.sparkSession
    rows: list[DataFrame] = []
    for config in configs:
        args, name = build_args(base or {}, config), config.get("name", "config")
        failed = False
        try:
            batch = _run_config(baskets_text, name, args, methods)
        except Exception as error:  # noqa: BLE001 - recorded as an error row
            batch, failed = _error_row(spark, name, args, error), True
        have = dict(batch.dtypes)
        batch = cut_lineage(batch.select(*[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in EXPERIMENT_SCHEMA]))
        rows.append(batch)
        if sink:
            write_experiment(batch, sink)
        if failed and not continue_on_error:
            break
    out = reduce(DataFrame.unionByName, rows)
    return out if timed else out.drop("elapsed_seconds", "fastest")
