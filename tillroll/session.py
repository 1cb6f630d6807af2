"""Session construction and cluster-safety helpers."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes above which a derived table is never broadcast; such sides
# are joined by shuffle instead.  Every broadcast in this package goes through
# ``broadcast_if_small`` so the bound is checked, never assumed.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 64 << 20
WIDE_ROW = 2048


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tillroll") -> SparkSession:
    """Session with AQE (partition coalescing and skew-join splitting) on.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; a
    machine-local folder would lose checkpoints with the executor, so it is
    only invented here when the master is local (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative mining")
    folder = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def _new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"


def _empty_folder(spark: SparkSession, folder: str) -> None:
    """Remove what a folder of tables holds: an overwrite without rows."""
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(folder)


class Scratch:
    """Written tables and caches owned by one job: a context that releases
    them at its end, also when the job fails.

    Iterative miners write one small table per level; once their result is
    written, those tables leave the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder: str | None = None
        self.tables = 0
        self.held: list[DataFrame] = []

    def cut(self, df: DataFrame) -> DataFrame:
        if self.folder is None:
            self.folder = _new_folder(self.spark)
        path = f"{self.folder}/{self.tables}"
        self.tables += 1
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)  # known: no job has to look into the files

    def hold(self, df: DataFrame) -> DataFrame:
        """Cache ``df`` (memory, then disk) until the end of the job."""
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.held[-1]

    def clear(self) -> int:
        """Release everything; returns how many tables there were."""
        for df in self.held:
            df.unpersist()
        self.held.clear()
        count, self.tables = self.tables, 0
        if self.folder is not None:
            folder, self.folder = self.folder, None
            _empty_folder(self.spark, folder)
        return count

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.clear()


_RESULTS: dict[str, Scratch] = {}  # by application: tables that nobody else owns


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Iterative jobs (one level per loop) would otherwise re-embed every
    earlier level's plan in the next one and spend their time planning.  A
    written table survives executor loss (unlike a local checkpoint), costs
    one job (an RDD checkpoint runs two) and reads back as a plan leaf whose
    row count comes from the Parquet footers.  ``release_tables`` empties the
    tables of a job whose results have been used."""
    spark = df.sparkSession
    return _RESULTS.setdefault(spark.sparkContext.applicationId, Scratch(spark)).cut(df)


def release_tables(spark: SparkSession) -> int:
    """Empty every table that ``cut_lineage`` has written and nobody has
    released yet; frames that read them must not be used afterwards.  Returns
    how many there were."""
    owner = _RESULTS.pop(spark.sparkContext.applicationId, None)
    return owner.clear() if owner else 0


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` cached (memory, then disk) for the block; whatever is to
    outlive the block has to be written inside it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def _width(df: DataFrame) -> Column:
    """Bytes of a row, measured where the type has no fixed width."""
    total = F.lit(16)
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            w = F.octet_length(c)
        elif kind == "array" and f.dataType.elementType.typeName() == "string":
            w = F.octet_length(F.array_join(c, "")) + F.size(c) * 8
        elif kind in ("array", "map"):
            w = F.size(c) * 16
        else:
            w = F.lit(16 if kind in ("struct", "decimal") else 8)
        total = total + F.coalesce(w, F.lit(0))
    return total


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``, in one job."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    return int(rows), int(size)


def fits(rows: int, size: int, row_limit: int = BROADCAST_ROW_LIMIT, byte_limit: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether a table of that many rows and bytes may be broadcast."""
    return rows <= row_limit and size <= byte_limit


def fits_broadcast(df: DataFrame, row_limit: int = BROADCAST_ROW_LIMIT, byte_limit: int = BROADCAST_BYTE_LIMIT) -> bool:
    return fits(*measured(df), row_limit, byte_limit)


def broadcast_if_small(df: DataFrame, row_limit: int = BROADCAST_ROW_LIMIT, known_rows: int | None = None,
                       byte_limit: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Broadcast hint only behind a measured row count and size; otherwise the
    join shuffles, and AQE may split its skewed partitions.  ``known_rows``
    (a bound the caller has counted) spares the job where it is over the
    limit, or so low that rows of ``WIDE_ROW`` bytes would still fit."""
    if known_rows is not None and known_rows > row_limit:
        return df
    if known_rows is not None and known_rows * WIDE_ROW <= byte_limit:
        return F.broadcast(df)
    return F.broadcast(df) if fits_broadcast(df, row_limit, byte_limit) else df


def support_threshold(min_support: float, n: int) -> int:
    """Absolute count threshold ``ceil(min_support * n)`` in double arithmetic."""
    return int(math.ceil(float(min_support) * float(n)))
