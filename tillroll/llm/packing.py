"""Best-fit packing of token pieces into sequences of a fixed capacity.

Only lengths decide a packing, and there are at most ``capacity`` of them.  So
the plan is made from the histogram of lengths (at most 4096 rows, whatever
the input's size): documents above one third of the capacity are matched
greedily, the largest with the largest that fits beside it, two per sequence
at most; the smaller ones go, longest first, to the sequence with the smallest
gap that takes them.  The plan is a list of segments ("items of length s with
ranks r.. go to sequences b.., k to each, from offset o").  Each piece then
finds its rank among the pieces of its length - by a window inside hash
buckets plus bucket offsets, so a hot length spreads over all buckets - and
looks its place up in the plan.  No piece is moved through the driver and no
sequence is assembled in one task.

Defined cases: null text is empty; every document has its end id, so at least
one token; a document of more than ``capacity`` tokens is cut into pieces of
that length, the last shorter; repeated rows are packed each; a null doc_id
stays null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, text_or_empty
from tillroll.session import cut_lineage

CAPACITY = 4096
END_ID = 1
BUCKET_ROWS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document (``PIECES``)."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from tillroll.llm.tokens import crc, encoded_slices

        step = 4 * capacity
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, encoded in encoded_slices(batch, tokenizer, 1, end_id):
                out: list[list] = [[], [], [], [], []]
                for i, e in enumerate(encoded, first):
                    view = memoryview(e)
                    for k, at in enumerate(range(0, len(e), step)):
                        chunk = view[at:at + step]
                        for col, v in zip(out, (ids[i], k, at // 4, len(chunk) // 4, crc(chunk))):
                            col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    return map_arrow(src, cut, PIECES)


class _Plan:
    """Segments of a packing; sequences with equal gaps are kept as ranges."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins = 0
        self.used: dict[int, int] = {}       # length -> items placed so far
        self.gaps: list[int] = []            # sorted gaps that have sequences
        self.ranges: dict[int, list[tuple[int, int]]] = {}
        self.segments: list[tuple[int, int, int, int, int, int]] = []

    def add_range(self, gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in self.ranges:
                self.ranges[gap] = []
                bisect.insort(self.gaps, gap)
            self.ranges[gap].append((first, n))

    def take_range(self, least: int) -> tuple[int, int, int] | None:
        """The smallest gap of at least ``least`` and one of its ranges."""
        at = bisect.bisect_left(self.gaps, least)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        first, n = self.ranges[gap].pop()
        if not self.ranges[gap]:
            del self.ranges[gap]
            self.gaps.pop(at)
        return gap, first, n

    def place(self, length: int, items: int, first: int, each: int, offset: int) -> None:
        """``items`` of ``length``, ``each`` per sequence from ``first`` on."""
        rank = self.used.get(length, 0)
        self.segments.append((length, rank, items, first, each, offset))
        self.used[length] = rank + items

    def open(self, n: int) -> int:
        self.bins += n
        return self.bins - n


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> _Plan:
    """Packing plan of ``histogram`` (length -> pieces)."""
    plan = _Plan(capacity)
    large = sorted(s for s in histogram if 3 * s > capacity)
    left = {s: histogram[s] for s in large}
    for a in reversed(large):
        fit = bisect.bisect_right(large, capacity - a) - 1
        while left[a]:
            while fit >= 0 and (not left[large[fit]] or (large[fit] == a and left[a] < 2)):
                fit -= 1
            if fit < 0:  # nothing fits beside the rest of this length
                first = plan.open(left[a])
                plan.place(a, left[a], first, 1, 0)
                plan.add_range(capacity - a, first, left[a])
                left[a] = 0
                break
            b = large[fit]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            first = plan.open(n)
            plan.place(a, n, first, 1, 0)
            plan.place(b, n, first, 1, a)
            left[a] -= n
            left[b] -= n
            plan.add_range(capacity - a - b, first, n)
    for s in sorted((s for s in histogram if 3 * s <= capacity), reverse=True):
        count = histogram[s]
        while count:
            found = plan.take_range(s)
            if found is None:
                each = capacity // s
                n = count // each
                if n:
                    first = plan.open(n)
                    plan.place(s, n * each, first, each, 0)
                    plan.add_range(capacity - each * s, first, n)
                if rest := count - n * each:
                    first = plan.open(1)
                    plan.place(s, rest, first, rest, 0)
                    plan.add_range(capacity - rest * s, first, 1)
                break
            gap, first, n = found
            each = min(gap // s, count)
            n_full = min(n, count // each)
            plan.place(s, n_full * each, first, each, capacity - gap)
            plan.add_range(gap - each * s, first, n_full)
            plan.add_range(gap, first + n_full, n - n_full)
            count -= n_full * each
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (``PIECES``) with sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = cut_lineage(pieces)
    by_length = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    plan = plan_packing({int(r["length"]): int(r["count"]) for r in by_length}, capacity)
    segments = sorted(plan.segments)
    rows = sum(r["count"] for r in by_length)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / BUCKET_ROWS))

    # the checksum deals out pieces that share an id, or have none
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = spread.groupBy("length", "bucket").count()
    w = Window.partitionBy("length").orderBy("bucket")
    offsets = counts.select("length", "bucket", (F.sum("count").over(w) - F.col("count")).alias("before"))
    # up to the checksum: a task that runs again gives every piece its rank again
    inside = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (spread.repartition("bucket").withColumn("nth", F.row_number().over(inside))
              .join(offsets, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("nth") - 1).alias("rank")))

    def look_up(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        seg = np.array(segments, dtype=np.int64).reshape(-1, 6)
        keys = (seg[:, 0] << 48) + seg[:, 1]  # by length, then by the first rank
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            at = seg[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            nth = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(at[:, 3] + nth // at[:, 4]),
                 pa.array(at[:, 5] + (nth % at[:, 4]) * length)],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    return map_arrow(ranked, look_up, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)
