"""Query registry: key -> (spark, sf_dir) -> DataFrame, plus DuckDB oracle SQL.

Each registered query reads the driver tables (or what Spark derives from
them) in full; nothing is sampled or capped except where a limit *is* the
feature (top-k reports, first-N selections).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn`` under ``key``; ``oracle`` is DuckDB SQL over the raw
    driver tables (omitted for operators SQL cannot express)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle.strip()
        return fn

    return wrap
