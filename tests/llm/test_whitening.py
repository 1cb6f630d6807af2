"""Whitening against numpy over all rows and exact whole numbers."""

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tillroll.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def grid(v):
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def check(got, rows, components=32, fit=None):
    """rows: (vec_id, vector) that take part; fit: x-vectors of the fit."""
    xs = [grid(v) for _, v in rows]
    fit = xs if fit is None else fit
    n, dim = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    e = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(dim, components)
    assert Counter(r["vec_id"] for r in got) == Counter({i: c * k for i, c in Counter(i for i, _ in rows).items()})
    deviation = Counter((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for (i, _), x in zip(rows, xs))
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == deviation
    assert all(r["n"] == n for r in got) and len({r["identity_error"] for r in got}) == 1
    for r in got:
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-6, abs=1e-12)
    return cov, e


def whitened(got, ids, k):
    z = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    return np.array([[z[i, c] for c in range(1, k + 1)] for i in ids], dtype=float)


def test_whole_query(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    cov, e = check(got, rows)
    assert got[0]["identity_error"] < 1e-9
    z = whitened(got, [i for i, _ in rows], 32)
    assert np.abs(z.T @ z / len(rows) - np.eye(32)).max() < 1e-9
    x = np.array([grid(v) for _, v in rows], dtype=float)
    own = (x - x.mean(axis=0)) @ np.linalg.eigh(cov)[1][:, ::-1][:, :32] / np.sqrt(e[:32])
    signs = np.sign((own * z).sum(axis=0))
    assert np.abs(own * signs - z).max() < 1e-6
    again = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    assert np.abs(whitened(again, [i for i, _ in rows], 32) - z).max() < 1e-9


def odd(rng):
    """A vector with copies, near copies on the grid, rows that go."""
    base = [[float(c) for c in rng.normal(size=4) * 3] for _ in range(80)]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(60)]
    rows += [(200 + i, [c + 1e-4 for c in base[1]]) for i in range(5)] + [(7, base[2]), (7, base[2]), (None, base[3])]
    gone = [(300, None), (301, [1.0, None, 2.0, 3.0]), (302, [1.0, math.nan, 0.0, 0.0]), (303, [math.inf, 0.0, 0.0, 0.0]),
            (304, []), (305, [1.0, 2.0]), (306, [0.0, 0.0, 0.0, -math.inf])]
    keep = [(i, np.array(v, dtype=np.float32).astype(float).tolist()) for i, v in rows]
    return rows, gone, keep


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_multiplicities_and_odd_rows(spark, weights):
    rows, gone, keep = odd(np.random.default_rng(3))
    table = spark.createDataFrame(rows + gone, SCHEMA)
    for c in ("h", "x", "w", "v", "z", "n", "component", "deviation"):
        table = table.selectExpr("*", f"'other' AS {c}")
    fit = None if weights == "counts" else [list(x) for x in {tuple(grid(v)) for _, v in keep}]
    got = whitening.whiten(table, weights=weights).collect()
    check(got, keep, fit=fit)
    assert got[0]["identity_error"] < 1e-9
    two = whitening.whiten(table, components=2, weights=weights).collect()
    check(two, keep, 2, fit)
    with pytest.raises(ValueError):
        whitening.whiten(table, weights="other")


def test_components_without_variance(spark):
    rows = [(i, [float(i % 5), float(2 * (i % 5)), 1.0]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(r["component"] for r in got) == {1: 40, 2: 40, 3: 40}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got) and got[0]["identity_error"] < 1e-9
    one = whitening.whiten(spark.createDataFrame(rows[:1], SCHEMA)).collect()
    assert [(r["whitened"], r["explained"], r["deviation"], r["n"]) for r in one] == [(None, 0.0, 0, 1)] * 3


def test_large_entries_and_empty(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [3e38, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and all(r["deviation"] is None for r in got)
    wide = [(1, [1e6, 0.0]), (2, [-1e6, 1.0]), (3, [5.0, 2.0])]
    check(whitening.whiten(spark.createDataFrame(wide, SCHEMA)).collect(), wide)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []


def test_exact_sums_of_large_numbers(spark):
    table = spark.createDataFrame([([2**61, -5], 3), ([2**61, 7], 2)], "x array<long>, w long").repartition(1)
    assert whitening.exact_sums(table) == (5, [5 * 2**61, -1])
