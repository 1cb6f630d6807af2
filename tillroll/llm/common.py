"""Column helpers and table helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import fits_broadcast

BATCH_ROWS = 1000
BROADCAST_ROWS = 500_000  # narrow rows; the byte limit of the session's helper holds as well
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# characters outside ASCII and a few blocks without capitals (Latin-1 small
# letters and signs, punctuation, Hebrew to Sinhala, kana to CJK, Hangul):
# lower() might change these
MAY_CHANGE = r"[^\x00-\x7F\u00A0-\u00BF\u00D7\u00DF-\u00FF\u0590-\u0DFF\u2010-\u2044\u20AC\u3040-\u9FFF\uAC00-\uD7A3]"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` gives the same for texts of characters
    that it leaves alone otherwise, and is several times faster than
    ``translate``."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .when(~c.rlike(MAY_CHANGE), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def text_or_empty(df: DataFrame, text: str = "text") -> Column:
    """The text column as a string, null as the empty string."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def broadcast_checked(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a written table whose rows and bytes were measured
    and are few; beyond the limits the join shuffles, and AQE splits its
    skewed partitions.  ``rows``: a count that the caller has."""
    if rows is not None and rows > limit:
        return df
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def drop_rows(docs: DataFrame, row_key: list[Column], names: list[str], dropped: DataFrame,
              repeated: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in ``dropped``; of rows that
    share a key in ``repeated`` one stays.  ``names`` are the key's columns in
    the two tables, which are written tables, so counting them is cheap."""
    cols = docs.columns
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(row_key, names)])

    def same(side: DataFrame):
        cond = None
        for n in names:
            c = keyed[n].eqNullSafe(side[n])
            cond = c if cond is None else cond & c
        return cond

    d = broadcast_checked(dropped)
    left = keyed.join(d, same(d), "left_anti")
    n_rep = repeated.count()
    if n_rep:
        r = broadcast_checked(repeated, n_rep)
        cond = None
        for n in names:
            c = left[n].eqNullSafe(r[n])
            cond = c if cond is None else cond & c
        once = left.join(r, cond, "left_anti")
        many = left.join(r, cond, "left_semi").dropDuplicates(names)
        left = once.unionByName(many)
    return left.select(*[left[f"`{c}`"] for c in cols])


_SHIPPED: set[str] = set()  # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, in the way
    ``--py-files`` does."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers, in batches of
    ``BATCH_ROWS`` rows at most: the default of 10,000 rows is sized for
    numbers, not for whole texts."""
    spark, rows = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    ship_package(spark)
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)
