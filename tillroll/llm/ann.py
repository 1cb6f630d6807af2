"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector minus the centre is scaled to length one, rotated at random and kept
as the signs of its coordinates, packed, with two scalars: its length and the
inner product of the code with the vector itself.  From these the inner
product with any query is estimated without bias, with an error bound that
holds with high probability (``eps`` standard deviations).  A vector is
reranked with the original numbers only where estimate plus bound reaches the
k-th best score found so far, so almost all are decided by their codes.

Scale: the index is a table, one row per vector.  The stated queries are taken
in blocks of about ``query_rows``; a block is broadcast (its size is fixed by
that parameter) and each task runs its rows against it, keeping k results per
query, so a task's memory does not grow with the table.  The results of all
tasks are merged per query by a window of (tasks x k) short rows.

Defined cases: vectors that are null, all zero, of another length than most,
or hold a null or non-finite component take no part, neither do rows without
vec_id; a repeated vec_id is one vector, its smallest; ties go to the smaller
vec_id; with fewer than k candidates all are returned; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow
from tillroll.session import cut_lineage

K = 20
EPS = 3.0
QUERY_ROWS = 4096
CENTRE_ROWS = 10_000  # vectors at most on which the centre is fitted and first bounds are taken
SCAN_ROWS = 2048
SEED = 7


def valid_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector): the rows that take part."""
    v = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    v = v.filter(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    size = v.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not size:
        return v.filter(F.lit(False))
    return v.filter(F.size("vector") == size[0]["d"])


def rotation(dim: int, seed: int = SEED):
    """A random orthogonal matrix."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(column):
    """An Arrow list column without nulls as a float64 matrix."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class CodeIndex:
    """The index table (row, vec_id, vector, code, length, overlap) and what
    is needed to ask it; ``row`` numbers the rows, below zero where there is
    no vec_id; ``sample`` holds a bounded number of (rows, vectors)."""

    def __init__(self, rows: DataFrame, centre, sample, seed: int):
        self.rows, self.centre, self.sample, self.seed = rows, centre, sample, seed


def build_index(vectors: DataFrame, seed: int = SEED, centre_rows: int = CENTRE_ROWS) -> CodeIndex | None:
    """Codes of all ``vectors`` (as ``valid_vectors`` gives them); None if there are none."""
    import numpy as np

    number = F.monotonically_increasing_id()
    vectors = cut_lineage(vectors.select(F.when(F.col("vec_id").isNull(), -1 - number).otherwise(number).alias("row"),
                                         "vec_id", "vector"))
    total, some = vectors.count(), vectors
    if total > centre_rows:  # by the hash first, so that about so many rows are sorted in all
        share = F.lit(int((1 << 30) * min(1.0, 1.1 * centre_rows / total)))
        some = vectors.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < share)
    some = some.orderBy(F.xxhash64("row")).limit(centre_rows).collect()
    if not some:
        return None
    sample = (np.array([r["row"] for r in some], dtype=np.int64),
              np.array([r["vector"] for r in some], dtype=np.float64))
    centre = sample[1].mean(axis=0)
    dim = len(centre)

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        turn = rotation(dim, seed)
        for batch in batches:
            rest = _matrix(batch.column(2)) - centre
            length = np.linalg.norm(rest, axis=1)
            unit = (rest / np.maximum(length, 1e-300)[:, None]) @ turn.T
            code = np.packbits(unit >= 0, axis=1)
            overlap = np.abs(unit).sum(axis=1) / math.sqrt(dim)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array(length), pa.array(np.maximum(overlap, 1e-12))],
                ["row", "vec_id", "vector", "code", "length", "overlap"])

    kind = vectors.schema["vector"].dataType.simpleString()
    rows = map_arrow(vectors, encode, f"row long, vec_id long, vector {kind}, code binary, length double, overlap double")
    return CodeIndex(cut_lineage(rows), centre, sample, seed)


def _best(k, rows, ids, scores, who):
    """Of (query, row, id, score) the k best of every query."""
    import numpy as np

    order = np.lexsort((rows, ids, rows < 0, -scores, who))
    who, rows, ids, scores = who[order], rows[order], ids[order], scores[order]
    starts = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.empty(0, np.int64)
    sizes = np.diff(np.concatenate([starts, [len(who)]]))
    nth = np.arange(len(who)) - np.repeat(starts, sizes)
    keep = nth < k
    return rows[keep], ids[keep], scores[keep], who[keep]


def _sample_bounds(index: CodeIndex, k: int):
    """mapInArrow function: (row, vec_id, vector, block) with, for every
    query, the k-th best score among the sample: the k-th best of the whole
    table is at least that."""
    import numpy as np

    numbers, vectors = index.sample

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            own, q_vec = batch.column(0).to_numpy(), _matrix(batch.column(2))
            out = np.full(len(own), -np.inf)
            for at in range(0, len(own) if len(numbers) > k else 0, 512):
                scores = q_vec[at:at + 512] @ vectors.T
                scores[own[at:at + 512, None] == numbers] = -np.inf
                out[at:at + 512] = np.partition(scores, len(numbers) - k, axis=1)[:, len(numbers) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], ["row", "vec_id", "vector", "block", "bound"])

    return run


def _scan(index: CodeIndex, q_row, q_ids, q_vec, bound, k: int, eps: float, scan_rows: int):
    """mapInArrow function: k best rows of a task for every query of a block.

    Scores and bounds are compared per unit of the query's length, so that
    estimate, error bound and the score to reach come out of one product of
    the codes (with two more columns) and the rotated queries."""
    import numpy as np

    centre, seed, dim = index.centre, index.seed, len(index.centre)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        q_len = np.maximum(np.linalg.norm(q_vec, axis=1), 1e-300)
        slack = 1e-5  # of single precision, per unit of both lengths
        asked = np.empty((len(q_row), dim + 2), dtype=np.float32)
        asked[:, :dim] = (q_vec @ rotation(dim, seed).T) / math.sqrt(dim) / q_len[:, None]
        asked[:, dim] = 1
        at_centre = (q_vec @ centre) / q_len
        rows_, ids, who, scores = *(np.empty(0, np.int64) for _ in range(3)), np.empty(0)
        least = bound.copy()
        for batch in batches:
            for at in range(0, len(batch), scan_rows):
                part = batch.slice(at, scan_rows)
                row, v = part.column(0).to_numpy(), _matrix(part.column(2))
                vec_id = part.column(1).fill_null(0).to_numpy()
                code = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(len(part), -1)
                length, overlap = part.column(4).to_numpy(), part.column(5).to_numpy()
                size = np.linalg.norm(v, axis=1)
                rows = np.empty((dim + 2, len(part)), dtype=np.float32)
                rows[:dim] = (np.unpackbits(code, axis=1, count=dim).astype(np.float32).T * 2 - 1) * (length / overlap)
                rows[dim] = length * eps * np.sqrt(np.maximum(0, 1 - overlap ** 2) / overlap ** 2 / max(1, dim - 1)) \
                    + slack * np.maximum(1, size)
                rows[dim + 1] = 1
                asked[:, dim + 1] = np.clip(at_centre - least / q_len, -1e30, 1e30)
                j, i = np.nonzero(asked @ rows >= 0)
                found_i, found_j = [], []
                ends = np.cumsum(np.bincount(j, minlength=len(q_row)))
                for q in np.flatnonzero(np.diff(ends, prepend=0)):
                    near = i[(ends[q - 1] if q else 0):ends[q]]
                    good = near[(v[near] @ q_vec[q] >= least[q] - 1e-9 * q_len[q]) & (row[near] != q_row[q])]
                    found_i.append(good)
                    found_j.append(np.full(len(good), q))
                if found_i:
                    i, j = np.concatenate(found_i), np.concatenate(found_j)
                    # one order of summation for all, so equal vectors score equally
                    exact = np.einsum("ij,ij->i", v[i], q_vec[j])
                    rows_, ids, scores, who = _best(k, np.concatenate([rows_, row[i]]), np.concatenate([ids, vec_id[i]]),
                                                    np.concatenate([scores, exact]), np.concatenate([who, j]))
                    n = np.bincount(who, minlength=len(q_row))
                    full = np.flatnonzero(n == k)
                    least[full] = np.maximum(least[full], scores[np.cumsum(n)[full] - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_row[who]), pa.array(q_ids[who], mask=q_row[who] < 0), pa.array(rows_),
             pa.array(ids, mask=rows_ < 0), pa.array(scores)], ["asked", "query_id", "row", "vec_id", "score"])

    return run


def search(index: CodeIndex | None, queries: DataFrame, k: int = K, eps: float = EPS, query_rows: int = QUERY_ROWS,
           scan_rows: int = SCAN_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row of
    ``queries``, rows of ``index.rows``; a query's own row is excluded."""
    import numpy as np

    spark = queries.sparkSession
    n = queries.count() if index is not None else 0
    parts = []
    if n:
        blocks = math.ceil(n / query_rows)
        asked = queries.select("row", "vec_id", "vector", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
        kind = asked.schema["vector"].dataType.simpleString()
        asked = cut_lineage(map_arrow(asked, _sample_bounds(index, k),
                                      f"row long, vec_id long, vector {kind}, block long, bound double"))
        order = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        for b in range(blocks):
            block = asked.filter(F.col("block") == b).orderBy("row").collect()  # about ``query_rows``
            if not block:
                continue
            scan = _scan(index, np.array([r["row"] for r in block], dtype=np.int64),
                         np.array([r["vec_id"] or 0 for r in block], dtype=np.int64),
                         np.array([r["vector"] for r in block], dtype=np.float64),
                         np.array([r["bound"] for r in block]), k, eps, scan_rows)
            found = map_arrow(index.rows, scan, "asked long, query_id long, row long, vec_id long, score double")
            found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
                "query_id", "rank", "vec_id", "score")
            parts.append(found if blocks == 1 else cut_lineage(found))
    if not parts:
        return spark.range(0).selectExpr("id AS query_id", "cast(0 AS int) AS rank", "id AS vec_id",
                                         "cast(0 AS double) AS score")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found
