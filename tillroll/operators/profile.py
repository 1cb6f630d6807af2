"""Data profiling: shape, nulls, distinct counts, date range, top articles.

Every profile is a single aggregation pass per table (map-side partial
aggregates), unpivoted into a long ``(table_name, column_name, value)`` form.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_shape(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _long(name: str, wide: DataFrame, value_name: str) -> DataFrame:
    return wide.unpivot([], wide.columns, "column_name", value_name).select(
        F.lit(name).alias("table_name"), "column_name", value_name
    )


def profile_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        _long(name, df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]), "null_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_distinct(tables: dict[str, DataFrame], approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column.

    Exact: an aggregate per column, each over a scan of that column alone, so
    together they read a columnar table once; values are made distinct before
    and after one shuffle, and no row is expanded once per column.  Store or
    hold derived tables first, as each aggregate computes them.
    ``approximate=True``: HyperLogLog++ sketches (one pass, fixed-size partial
    state).
    """
    if approximate:
        parts = [_long(name, df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in df.columns]), "distinct_count")
                 for name, df in tables.items()]
    else:
        parts = [df.agg(F.count_distinct(F.col(c)).alias("distinct_count")).select(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), "distinct_count")
            for name, df in tables.items() for c in df.columns]
    return reduce(DataFrame.unionByName, parts)


def profile_date_range(lines: DataFrame, column: str = "t_dat") -> DataFrame:
    return lines.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def top_articles(lines: DataFrame, n: int = 10, column: str = "article_id") -> DataFrame:
    """Most frequent values by line count, ties by value ascending."""
    counts = lines.groupBy(column).agg(F.count(F.lit(1)).alias("line_count"))
    return counts.orderBy(F.desc("line_count"), F.asc(column)).limit(n)
