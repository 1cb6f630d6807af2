"""The first N rows of an order, without sorting or writing the input.

A sample shows about which key has rank N.  One pass counts the rows between a
few keys of the sample around that rank, closer together near it; the range
that holds rank N is known from the counts, and all ranges before it are in.
If that range is still large it is sampled and counted again.  At the end the
rows below it are read with a filter, and only its own rows are sorted.

Each round reads the input twice (the later ones a range that the scan can
prune) and shrinks the range some hundred to some thousand times, so 10^12
rows take two or three rounds.  Derived inputs are computed again in each pass;
store them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE_ROWS = 100_000  # a range of so many rows is sorted
SAMPLE_ROWS = 4096
STEPS = [0] + [s * d for d in (1, 3, 10, 30, 100, 300, 1000) for s in (-1, 1)]  # places in the sample around the rank


class Order:
    """Comparisons of rows with keys, in the order of the columns, nulls first."""

    def __init__(self, df: DataFrame, columns: list[str]):
        self.columns = columns
        self.types = [df.schema[c].dataType for c in columns]
        self.key = F.struct(*columns)

    def literal(self, key: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(self.columns, key, self.types)])

    def within(self, low: tuple | None, high: tuple | None) -> Column:
        """Keys between both, exclusive.  The condition on the first column
        alone says less but reaches the scan."""
        first, out = F.col(self.columns[0]), F.lit(True)
        if low is not None:
            out = out & (self.key > self.literal(low))
            if low[0] is not None:
                out = out & (first >= F.lit(low[0]))
        if high is not None:
            out = out & (self.key < self.literal(high))
            if high[0] is not None:
                out = out & (first.isNull() | (first <= F.lit(high[0])))
        return out

    def bucket(self, keys: list[tuple]) -> Column:
        """2i: between keys i - 1 and i; 2i + 1: key i itself."""

        def tree(a: int, b: int) -> Column:
            if a == b:
                return F.lit(2 * a)
            mid = (a + b) // 2
            at = self.literal(keys[mid])
            return F.when(self.key < at, tree(a, mid)).when(self.key == at, F.lit(2 * mid + 1)).otherwise(tree(mid + 1, b))

        return tree(0, len(keys))


def _keys_around(sample: list[tuple], place: int) -> list[tuple]:
    """Different keys of the sorted sample, close together around ``place``."""
    places = sorted({min(max(place + s, 0), len(sample) - 1) for s in STEPS})
    return list(dict.fromkeys(sample[p] for p in places))


def first_rows(df: DataFrame, n: int, order_cols: list[str], edge_rows: int = EDGE_ROWS,
               sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows in ``order_cols`` order (nulls first), spread over
    the tasks that read them.  Of rows with the last key that is taken, any
    are taken.  With ``n`` rows or fewer all are returned."""
    if n <= 0:
        return df.filter(F.lit(False))
    size = df.count()
    if size <= n:
        return df
    order, low, high, taken, seed = Order(df, order_cols), None, None, 0, 0
    while size > edge_rows:
        rows = df.select(*order_cols).filter(order.within(low, high))
        seed += 1
        sample = [tuple(r) for r in rows.sample(min(1.0, sample_rows / size), seed).orderBy(*order_cols).collect()]
        if not sample:
            continue
        keys = _keys_around(sample, (n - taken) * len(sample) // size)
        counts = {r["bucket"]: r["count"] for r in rows.groupBy(order.bucket(keys).alias("bucket")).count().collect()}
        bucket = 0
        while taken + counts.get(bucket, 0) < n:
            taken += counts.get(bucket, 0)
            bucket += 1
        at = bucket // 2
        if bucket % 2:  # rank n is a key itself: nothing has to be sorted
            last = order.literal(keys[at])
            return df.filter(order.within(None, keys[at])).unionByName(df.filter(order.key == last).limit(n - taken))
        size = counts[bucket]
        low, high = keys[at - 1] if at else low, keys[at] if at < len(keys) else high
    edge = df.filter(order.within(low, high)).orderBy(*order_cols).limit(n - taken)
    if low is None:
        return edge
    return df.filter(order.within(None, low) | (order.key == order.literal(low))).unionByName(edge)
