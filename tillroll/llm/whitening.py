"""Embedding whitening by a covariance weighted with multiplicities.

The entries of the vectors are put on a grid of whole numbers, so that equal
x-vectors can be grouped exactly.  Everything after that is done once for each
distinct vector:

1. group identical x-vectors and count them;
2. sums of every dimension, exactly (whole numbers), weighted by the counts
   (or by one);
3. centre, then multiply: each task adds up the outer products of its centred
   vectors, weighted, as one matrix product a batch; the partial matrices are
   added row by row by the number of the matrix row;
4. eigenvectors of the d x d matrix (on the driver: d numbers a side);
5. whiten each distinct vector, and join the rows back to it.

Scale: grouping and joining are the two shuffles.  A vector that a third of
all rows share is one row after the map-side count, and its rows sit on the
left of a join that AQE splits.  What reaches the driver are the d sums and
the d x d matrix, whatever the number of rows.

Centring is exact up to one rounding: with q the mean rounded to a whole
number, x - q and the remainder of the mean are small.

Defined cases: vectors that are null, empty, of another length than most, or
hold a null or non-finite entry take no part; entries beyond the grid's range
(2^61) are put at its end; a null vec_id is kept; rows that repeat are kept;
components without variance (a rank below the dimension, or one vector alone)
have a null ``whitened`` and are left out of the identity check; a deviation
beyond 64 bits is null; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow
from tillroll.session import cut_lineage

GRID = 64            # x = floor(GRID * c) + OFFSET
OFFSET = 1_000_000
FARTHEST = 2.0 ** 61
COMPONENTS = 32
RANK = 1e-11         # an eigenvalue below this share of the largest is no variance
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def grid_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, h, x): the rows that take part; ``h`` is a hash of ``x``."""
    v = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    v = v.filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    # one row a length and task; the few lengths there are are compared on the driver
    most = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    v = v.filter(F.size("v") == (most[0]["d"] if most else 0))
    far = F.lit(FARTHEST)
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c.cast("double") * GRID, far), -far)) + OFFSET)
    return v.select("vec_id", x.alias("x")).select("vec_id", F.xxhash64("x").alias("h"), "x")


def distinct_vectors(rows: DataFrame, weights: str = "counts") -> DataFrame:
    """(h, x, w): every x-vector once, a written table."""
    if weights not in ("counts", "one"):
        raise ValueError("weights must be counts or one")
    w = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    return cut_lineage(rows.groupBy("h", "x").agg(w.alias("w")))


def _integers(column):
    """An Arrow list column as a matrix of whole numbers."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def exact_sums(table: DataFrame) -> tuple[int, list[int]]:
    """Weight of all rows and the weighted sum of every dimension."""

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, sums = 0, None
        for batch in batches:
            x, w = _integers(batch.column(0)), batch.column(1).to_numpy()
            n += int(w.sum())
            if int(abs(x).max(initial=0)) * int(w.sum()) >= 1 << 62:
                x, w = x.astype(object), w.astype(object)
            part = [int(s) for s in w @ x] if len(w) else []
            sums = part if sums is None else [a + b for a, b in zip(sums, part)] if part else sums
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in sums]])], ["n", "sums"])

    parts = map_arrow(table.select("x", "w"), partial, "n long, sums array<string>")
    each = parts.select("n", F.posexplode("sums").alias("j", "s"))
    got = each.groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return (int(got[0]["n"]) if got else 0), [int(r["s"]) for r in sorted(got, key=lambda r: r["j"])]


class Centre:
    """The mean of the fit as a whole number and a remainder, by dimension."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - q * n for s, q in zip(sums, self.whole)]  # within n / 2 of 0

    def centred(self, x):
        import numpy as np

        return (x - np.array(self.whole, dtype=np.int64)) - np.array(self.rest, dtype=np.float64) / self.n

    def deviations(self, x) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exactly."""
        import numpy as np

        near = x - np.array(self.whole, dtype=np.int64)
        if x.shape[1] * (self.n * (int(abs(near).max(initial=0)) + 1)) ** 2 < 1 << 63:
            return ((near * self.n - np.array(self.rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        wide = near.astype(object) * self.n - np.array(self.rest, dtype=object)
        return [int(d) if d < 1 << 63 else None for d in (wide ** 2).sum(axis=1)]


def weighted_gram(table: DataFrame, size: int, matrix: Callable):
    """Sum over all rows of w * c c^T; ``matrix`` makes an Arrow batch into
    (weights, rows c of ``size`` numbers).  Partial matrices meet by the
    number of the matrix row."""
    import numpy as np

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, any_row = np.zeros((size, size)), False
        for batch in batches:
            w, c = matrix(batch)
            total += (c * w[:, None]).T @ c
            any_row |= len(w) > 0
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)),
                                              pa.array([r.tobytes() for r in total], pa.binary())], ["i", "v"])

    def added(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(v)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                              pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["i", "v"])

    parts = map_arrow(table, partial, "i int, v binary").repartition("i")
    out = np.zeros((size, size))
    for r in map_arrow(parts, added, "i int, v binary").collect():  # ``size`` rows
        out[r["i"]] = np.frombuffer(r["v"])
    return out


def principal(gram, n: int, components: int = COMPONENTS):
    """(eigenvalues, unit eigenvectors as columns, shares of the trace) of the
    first components with variance, and the shares of all asked for."""
    import numpy as np

    cov = (gram + gram.T) / 2 / n
    e, vectors = np.linalg.eigh(cov)
    order = np.argsort(-e, kind="stable")[:components]
    e, vectors, trace = e[order], vectors[:, order], float(np.trace(cov))
    shares = [max(float(v), 0.0) / trace if trace > 0 else 0.0 for v in e]
    rank = int((e > RANK * max(float(e[0]), 0.0)).sum()) if len(e) and e[0] > 0 else 0
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return e[:rank], (vectors * sign)[:, :rank], shares


def whiten(table: DataFrame, components: int = COMPONENTS, weights: str = "counts", vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error: a row for each row that takes part and each component."""
    import numpy as np

    rows = grid_vectors(table, vec_id, vector)
    distinct = distinct_vectors(rows, weights)
    n, sums = exact_sums(distinct)
    if not n:
        return table.sparkSession.createDataFrame([], SCHEMA)
    centre, dim = Centre(n, sums), len(sums)

    def fitted(batch):
        return batch.column(1).to_numpy().astype(np.float64), centre.centred(_integers(batch.column(0)))

    values, vectors, shares = principal(weighted_gram(distinct.select("x", "w"), dim, fitted), n, components)
    k = len(values)

    def project(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = _integers(batch.column(1))
            z = centre.centred(x) @ vectors / np.sqrt(values)
            ends = pa.array(np.arange(len(x) + 1) * k, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(centre.deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(z.ravel(), pa.float64()))],
                ["h", "x", "w", "deviation", "z"])

    white = cut_lineage(map_arrow(distinct, project, "h long, x array<long>, w long, deviation long, z array<double>"))

    def with_one(batch):
        z = batch.column(0).flatten().to_numpy().reshape(len(batch), k)
        return batch.column(1).to_numpy().astype(np.float64), np.column_stack([z, np.ones(len(z))])

    error = 0.0
    if k:
        g = weighted_gram(white.select("z", "w"), k + 1, with_one) / n
        error = float(np.abs(g[:k, :k] - np.outer(g[:k, k], g[:k, k]) - np.eye(k)).max())
    joined = rows.join(white.select("h", "x", "deviation", "z"), ["h", "x"])
    each = joined.select("vec_id", "deviation", "z", F.explode(F.sequence(F.lit(1), F.lit(len(shares)))).alias("component"))
    return each.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation",
        F.get("z", F.col("component") - 1).alias("whitened"),
        F.get(F.array(*[F.lit(s) for s in shares]), F.col("component") - 1).alias("explained"),
        F.lit(error).alias("identity_error"))
