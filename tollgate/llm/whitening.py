"""Whitening of embeddings by polarised covariances.

Entries become integers, floor(scale * c). The covariance of two dimensions is
never summed as a product. Each task squares the centred values n * x - S (n
vectors, S the dimension's sum) of every dimension, and of the sum of every pair
of dimensions; the sums of these squares are n^3 times variances, and

    2 cov(i, j) = var(x_i + x_j) - var(x_i) - var(x_j)

recovers every cross-covariance. All sums are exact integers (two limbs in
numpy, three in Spark's sums); each covariance is rounded once, when it becomes
a double for ``eigh``. To the driver come one number a pair of dimensions and a
few a component; that depends on the width of the vectors alone.

The fit list holds each different integer vector once (a distinct, which Spark
pre-aggregates: a vector that holds a third of all rows is one row a task).

Defined cases: a null vector, or one with a null, infinite or NaN entry, is
dropped; an entry beyond the long range saturates there; of vectors of several
widths, the width with most rows stays (of equals, the widest) and others are
dropped; an empty vector has no component. A component without variance (equal
vectors, fewer vectors than dimensions) has whitened and explained 0 and no part
in ``identity_error``, which is 0 where no component has variance. Equal rows,
null and repeated ids are whitened one by one. ``deviation`` is null beyond the
long range; ``deviation_exact`` has it as a decimal of 38 digits (null beyond
those). An empty table gives no rows. Extra columns are left out; no text is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Written

#: Low limb of a centred value, and rows whose squared limbs an int64 can sum.
LIMB, ROWS = 26, 1 << 10
#: Digits of a limb of the sums.
DIGITS = 18


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one width, without nulls, as an array of rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - S: int64 where it is small enough for two limbs, else Python integers."""
    reach = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, s)) if x.size else 0
    if reach < 1 << (2 * LIMB - 2):
        return x.astype(np.int64) * n - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def sum_of_squares(y: np.ndarray) -> np.ndarray:
    """Exact column sums of the squares, as Python integers."""
    if y.dtype == object:
        return (y * y).sum(axis=0)
    out = np.zeros(y.shape[1], object)
    for at in range(0, len(y), ROWS):
        part = y[at:at + ROWS]
        high, low = part >> LIMB, part & ((1 << LIMB) - 1)
        hh, hl, ll = ((a * b).sum(axis=0).astype(object) for a, b in ((high, high), (high, low), (low, low)))
        out = out + (hh << (2 * LIMB)) + (hl << (LIMB + 1)) + ll
    return out


def limbs(v: int) -> tuple[int, int, int]:
    rest, low = divmod(v, 10 ** DIGITS)
    high, mid = divmod(rest, 10 ** DIGITS)
    return high, mid, low


LIMBS = ("high", "mid", "low")
SQUARES = "i int, j int, high long, mid long, low long"


def square_sums(n: int, s: list[int]):
    """Arrow function: vectors to sums of squares of every dimension (j = i) and
    of every pair sum, one row each for the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(s)
        totals = [np.zeros(d - i, object) for i in range(d)]
        seen = False
        for b in batches:
            if not b.num_rows:
                continue
            seen = True
            y = centred(matrix(b.column("x")), n, s)
            for at in range(0, len(y), ROWS):
                part = np.asfortranarray(y[at:at + ROWS])
                for i in range(d):
                    sums = part[:, i:] + part[:, i:i + 1]
                    sums[:, 0] = part[:, i]
                    totals[i] = totals[i] + sum_of_squares(sums)
        if not seen:
            return
        for i in range(d):
            parts = [limbs(int(v)) for v in totals[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d - i, i, np.int32)), pa.array(np.arange(i, d, dtype=np.int32)), *(pa.array(c, pa.int64()) for c in zip(*parts))],
                ["i", "j", *LIMBS])

    return run


def covariance(squares: dict[tuple[int, int], int], n: int, d: int) -> np.ndarray:
    """The covariance matrix from sums of squares of n * x - S, by polarisation."""
    v = np.empty((d, d))
    for i in range(d):
        v[i, i] = Fraction(squares[i, i], n ** 3)
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = Fraction(squares[i, j] - squares[i, i] - squares[j, j], 2 * n ** 3)
    return v


def project(n: int, s: list[int], basis: np.ndarray):
    """Arrow function: keep the key, add deviation limbs and projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = centred(matrix(b.column("x")), n, s)
            if y.dtype == object or (np.abs(y).max() if y.size else 0) >= 1 << 28:
                parts = [pa.array(c, pa.int64()) for c in zip(*[limbs(int(t)) for t in (y.astype(object) ** 2).sum(axis=1)])]
            else:
                high, low = np.divmod((y * y).sum(axis=1), 10 ** DIGITS)
                parts = [pa.array(np.zeros(len(y), np.int64)), pa.array(high), pa.array(low)]
            w = (y.astype(np.float64) / n) @ basis
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * basis.shape[1]), pa.array(w.ravel()))
            keep = [c for c in b.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *parts, lists], [*keep, *LIMBS, "w"])

    return run


class Whitening:
    """A fit: ``n``, sums ``s``, covariance ``v``, falling eigenvalues ``e``,
    their unit vectors (columns of ``u``)."""

    def __init__(self, fit: DataFrame, d: int):
        sums = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
        rows = {r.i: r for r in sums.collect()}  # a row a dimension
        self.n, self.d = rows[0].n, d
        self.s = [int(rows[i].s) for i in range(d)]
        parts = fit.mapInArrow(square_sums(self.n, self.s), SQUARES)
        parts = parts.groupBy("i", "j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in LIMBS])
        base = 10 ** DIGITS
        squares = {(r.i, r.j): (int(r.high) * base + int(r.mid)) * base + int(r.low) for r in parts.collect()}  # a row a pair of dimensions
        self.v = covariance(squares, self.n, d)
        e, u = np.linalg.eigh(self.v)
        self.e, self.u = e[::-1], u[:, ::-1]
        self.trace = float(np.trace(self.v))

    def basis(self, k: int) -> np.ndarray:
        """Columns that whiten: unit vector over sqrt(eigenvalue), 0 without variance."""
        e, u = self.e[:k], self.u[:, :k]
        some = e > self.trace * self.d * np.finfo(float).eps
        return np.where(some, u / np.sqrt(np.where(some, e, 1.0)), 0.0)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, components: int = 4) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error, deviation_exact. Building the plan runs
    the fit."""
    c = F.col(f"`{vector_col}`").cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    x = F.transform("c", lambda v: F.floor(F.lit(scale) * v).cast("long"))
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), c.alias("c")).filter(F.col("c").isNotNull() & ~F.exists("c", bad))
    schema = f"vec_id {df.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    widths = rows.groupBy(F.size("c").alias("d")).agg(F.count("*").alias("k")).orderBy(F.desc("k"), F.desc("d")).head(1)
    if not widths or not widths[0].d:
        return df.sparkSession.createDataFrame([], schema)
    d = widths[0].d
    rows = rows.filter(F.size("c") == d).select("vec_id", x.alias("x"))
    fit = Written(rows.select("x").distinct(), "fit-list").df
    w = Whitening(fit, d)
    k = min(components, d)
    basis = w.basis(k)
    some = [i for i in range(k) if basis[:, i].any()]
    error = 0.0
    if some:
        on_fit = fit.mapInArrow(project(w.n, w.s, basis), "high long, mid long, low long, w array<double>")
        pairs = [(i, j) for i in some for j in some if i <= j]
        cov = on_fit.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(cov, pairs))
    explained = [float(w.e[i]) / w.trace if i in some else 0.0 for i in range(k)]
    kind = rows.schema["vec_id"].dataType.simpleString()
    out = rows.mapInArrow(project(w.n, w.s, basis), f"vec_id {kind}, high long, mid long, low long, w array<double>")
    exact, base = F.col("high").cast("decimal(38,0)"), F.lit(10 ** DIGITS).cast("decimal(19,0)")
    for c in LIMBS[1:]:
        exact = F.try_add(F.try_multiply(exact, base), F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)")
    shares = F.array(*[F.lit(v) for v in explained])
    return out.select("vec_id", exact.alias("deviation_exact"), F.posexplode("w").alias("p", "whitened")).select(
        "vec_id", (F.col("p") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), F.col("deviation_exact").try_cast("long").alias("deviation"),
        "whitened", F.get(shares, F.col("p")).alias("explained"), F.lit(float(error)).alias("identity_error"), "deviation_exact")
