"""Token ids as ORC files, in ascending doc_id order.

Texts are range-partitioned by doc_id before they are tokenised (a text is
smaller than its ids), each task writes one file of its range.  ORC keeps the
ids in run-length encoded stripes; the files carry row indexes and a Bloom
filter on doc_id, so a reader takes stripes in parallel and a lookup of a few
ids skips files, stripes and row groups by their metadata.

Defined cases: null text is empty (one token, the end id); null doc_ids come
first; rows that share an id follow each other in the order of their texts; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, text_or_empty
from tillroll.session import cut_lineage

END_ID = 1
LAYOUT = "part int, doc_id long, seq long, n_tokens int, ids array<int>"
HEAD = 64  # characters of a text by which rows of one id are dealt to files


def write_token_orc(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, stripe_bytes: int = 16 << 20,
                    index_rows: int = 1000, bloom_fpp: float = 0.01, compression: str = "zstd") -> None:
    """``part`` numbers the ranges of ids in their order, ``seq`` the rows of
    a part.  Rows are ordered by id, those of one id by their text, so an id
    that very many rows share (or lack) is spread over several files."""

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from tillroll.llm.tokens import encoded_slices

        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids = batch.column(0)
            for first, encoded in encoded_slices(batch, tokenizer, 1, end_id):
                n = np.array([len(e) // 4 for e in encoded], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
                ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, dtype=np.int32)), doc_ids.slice(first, len(n)),
                     pa.array(np.arange(seq, seq + len(n), dtype=np.int64)),
                     pa.array(n), pa.ListArray.from_arrays(pa.array(ends), flat)],
                    ["part", "doc_id", "seq", "n_tokens", "ids"])
                seq += len(n)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    ranged = src.repartitionByRange("doc_id", F.substring("text", 1, HEAD)).sortWithinPartitions("doc_id", "text")
    (map_arrow(ranged, encode, LAYOUT).write.mode("overwrite")
     .option("compression", compression)
     .option("orc.stripe.size", str(stripe_bytes))
     .option("orc.row.index.stride", str(index_rows))
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", str(bloom_fpp))
     .orc(path))


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAYOUT).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of a few documents; the filter reaches the ORC reader, which skips
    by stripe statistics, row index and Bloom filter."""
    return read_token_orc(spark, path).filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    A part is a range of ids, so a document's start is the sum over earlier
    parts plus a running sum inside its own."""

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from tillroll.llm.tokens import crc

        for batch in batches:
            lists = batch.column(3)
            flat = memoryview(lists.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            crcs = [crc(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array((ends[1:] - ends[:-1]).astype("int64")),
                 pa.array(crcs, pa.int64())], ["part", "doc_id", "seq", "n_tokens", "ids_crc32"])

    raw = read_token_orc(spark, path).select("part", "doc_id", "seq", "ids")
    rows = cut_lineage(map_arrow(raw, check, "part int, doc_id long, seq long, n_tokens long, ids_crc32 long"))
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # one row per file
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(before, "part")
            .select("doc_id", (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32"))
