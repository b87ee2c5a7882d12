"""Whitening against exact fractions and numpy; polarised sums; odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tollgate.llm import whitening as W


def plain(vectors):
    """n, sums, exact covariance and integer rows of the fit list."""
    x = [tuple(math.floor(256 * c) for c in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    s = [sum(v[i] for v in fit) for i in range(d)]
    cov = [[sum((n * v[i] - s[i]) * (n * v[j] - s[j]) for v in fit) / Fraction(n) ** 3 for j in range(d)] for i in range(d)]
    return x, n, s, cov


def check(rows, ids, vectors, components):
    x, n, s, cov = plain(vectors)
    v = np.array([[float(c) for c in r] for r in cov])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * components
    for k in range(components):
        want = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s)] for r in x]) @ u[:, k] / math.sqrt(e[k])
        have = np.array([got[i, k + 1].whitened for i in ids])
        sign = 1 if abs(have - want).max() < abs(have + want).max() else -1
        assert np.allclose(have, sign * want, rtol=1e-9, atol=1e-9)
        for i, r in zip(ids, x):
            row = got[i, k + 1]
            assert row.n == n and row.deviation == sum((n * a - b) ** 2 for a, b in zip(r, s)) == row.deviation_exact
            assert abs(row.explained - e[k] / np.trace(v)) < 1e-9 and row.identity_error < 1e-9


@pytest.mark.parametrize("seed,d,k", [(1, 6, 4), (2, 3, 3), (3, 9, 2)])
def test_equals_plain(spark, seed, d, k):
    rng = random.Random(seed)
    mix = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(d)]
    vectors = [[sum(rng.gauss(0, 1 + j) * mix[j][i] for j in range(d)) + 5 for i in range(d)] for _ in range(60)]
    vectors += [vectors[0]] * 40  # one vector holds much of the rows, and once counts
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    check(W.whiten(df, components=k).collect(), range(len(vectors)), vectors, k)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -0.25, 1.0], [0.1, 0.2, -0.3], [0.5, -0.25, 1.0], [-0.9, 0.4, 0.0], [0.3, 0.3, 0.7]]
    bad = [None, [0.1, None, 0.2], [nan, 0.0, 0.0], [0.0, inf, 0.0], [0.0, 0.0, -inf], [1.0, 2.0], [], [1.0] * 5]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)] + [(100 + i, v, 2, "y") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, n string")
    got = W.whiten(df).collect()
    singles = [np.array(v, np.float32).astype(float).tolist() for v in good]
    check([r for r in got if r.component <= 2], range(5), singles, 2)
    assert {r.component for r in got} == {1, 2, 3}
    null_ids = spark.createDataFrame([(None, v) for v in good[:2]] + [(1, good[3]), (1, good[3])], "vec_id long, embedding array<double>")
    assert sorted(str(r.vec_id) for r in W.whiten(null_ids, components=1).collect()) == ["1", "1", "None", "None"]


def test_no_variance_and_empty(spark):
    df = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(3)], "vec_id long, embedding array<double>")
    got = W.whiten(df).collect()
    assert len(got) == 6 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, 0.0, 0.0, 0.0) for r in got)
    flat = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    got = W.whiten(flat).collect()
    assert {r.whitened for r in got if r.component == 2} == {0.0} and {r.explained for r in got if r.component == 1} == {1.0}
    assert all(r.identity_error < 1e-12 for r in got)
    for empty in (df.limit(0), df.filter("vec_id < 0"), spark.createDataFrame([(1, []), (2, None)], "vec_id long, embedding array<double>")):
        out = W.whiten(empty)
        assert out.count() == 0 and out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_beyond_long(spark):
    vectors = [[1e10, 3.0], [-2e10, 1.0], [1e300, 2.0], [5.0, -7.5]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = W.whiten(df).collect()
    x = [[min(max(math.floor(256 * c), -1 << 63), (1 << 63) - 1) for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x)]
    for r in got:
        exact = sum((4 * a - b) ** 2 for a, b in zip(x[r.vec_id], s))
        assert r.deviation == (exact if exact < 1 << 63 else None)
        assert r.deviation_exact == (exact if exact < 10 ** 38 else None)


def test_sums_are_exact():
    rng = np.random.default_rng(5)
    for bits in (20, 40, 51):
        y = rng.integers(-(1 << bits), 1 << bits, (3000, 3))
        assert W.sum_of_squares(y).tolist() == [sum(int(v) ** 2 for v in c) for c in y.T]
    for v in (0, 7, 10 ** 18, 3 * 10 ** 40 + 5):
        high, mid, low = W.limbs(v)
        assert (high * 10 ** 18 + mid) * 10 ** 18 + low == v


def test_query(spark):
    from tollgate.llm.whitening_query import op13_whitening

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(op13_whitening(spark, sf).collect(), [r.vec_id for r in rows], [r.embedding for r in rows], 4)
