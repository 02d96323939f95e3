"""Whitening of embeddings: leading components of their covariance by contour integration.

Spark removes repeated vectors, sums them and adds up their centred products; only the
covariance (dimension squared) reaches the driver. There its components are found interval
by interval: a quadrature of solves with complex shifts of the covariance along a circle
around the interval projects random vectors onto the components whose eigenvalues lie
inside, a Rayleigh-Ritz step extracts them, and the inertia of the shifted covariance at
both ends tells how many there must be.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import stored

#: Wanted eigenvalues per interval, and nodes of the quadrature on the upper half circle.
WIDTH, NODES = 8, 8
ROUNDS = 60
EPS = np.finfo(float).eps
LIMIT = float(2**62)


# -- eigenvalues by inertia ------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a similar tridiagonal matrix (Householder)."""
    a = matrix.astype(float).copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        end = -np.copysign(length, x[0])
        x[0] -= end
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1 :, k] = 0
        a[k + 1, k] = end
    return np.diag(a).copy(), np.diag(a, -1) ** 2


class Spectrum:
    """Counts and places of eigenvalues of a symmetric matrix, from inertia only."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.squares = tridiagonal(matrix)
        reach = np.zeros(len(matrix))
        side = np.sqrt(self.squares)
        reach[:-1] += side
        reach[1:] += side
        self.low = float((self.diagonal - reach).min())
        self.high = float((self.diagonal + reach).max())
        self.scale = max(abs(self.low), abs(self.high), np.finfo(float).tiny)
        self.low -= 0.01 * self.scale
        self.high += 0.01 * self.scale

    def above(self, shift: float) -> int:
        """Positive pivots of the shifted matrix: how many eigenvalues exceed ``shift``."""
        tiny = EPS * EPS * self.scale
        count, pivot = 0, 1.0
        for d, square in zip(self.diagonal, np.concatenate(([0.0], self.squares))):
            pivot = d - shift - square / pivot
            if abs(pivot) < tiny:
                pivot = -tiny
            count += pivot > 0
        return count

    def place(self, k: int) -> float:
        """The ``k``-th largest eigenvalue by halving, to the precision of doubles."""
        low, high = self.low, self.high
        while high - low > 4 * EPS * self.scale:
            middle = (low + high) / 2
            if self.above(middle) >= k:
                low = middle
            else:
                high = middle
        return (low + high) / 2

    def intervals(self, k: int) -> list[tuple[float, float, int]]:
        """Intervals, falling, that hold at least the ``k`` largest eigenvalues, and counts.

        Ends lie in gaps: eigenvalues too close to be told apart share an interval, so that
        the last one may hold more than asked for.
        """
        out, top, have = [], self.high, 0
        while have < k:
            end = min(have + WIDTH, k)
            while end < len(self.diagonal):
                this, following = self.place(end), self.place(end + 1)
                if this - following > 1e-9 * self.scale:
                    break
                end += 1
            bottom = (this + following) / 2 if end < len(self.diagonal) else self.low
            out.append((bottom, top, end - have))
            top, have = bottom, end
        return out


def project(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0):
    """The ``count`` eigenpairs in ``(low, high]``, rising.

    Rounds of contour integration and Rayleigh-Ritz until as many pairs as the inertia
    says have residuals at rounding level; a basis that does not get there is doubled.
    """
    d = len(matrix)
    scale = max(np.abs(matrix).sum(0).max(), np.finfo(float).tiny)
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 - points))
    identity = np.eye(d)
    random = np.random.default_rng(seed)
    size = min(d, count + max(count, 8))
    while True:
        basis = random.standard_normal((d, size))
        for _ in range(ROUNDS):
            image = np.zeros((d, size))
            for turn, weight in zip(turns, weights):
                shifted = (centre + radius * turn) * identity - matrix
                image += weight / 2 * (radius * turn * np.linalg.solve(shifted, basis)).real
            q, _ = np.linalg.qr(image)
            values, inner = np.linalg.eigh(q.T @ matrix @ q)
            basis = q @ inner
            left = np.linalg.norm(matrix @ basis - basis * values, axis=0)
            found = (values > low) & (values <= high) & (left <= 8 * d * EPS * scale)
            if found.sum() == count:
                return values[found], basis[:, found]
        if size == d:
            raise ArithmeticError(f"{found.sum()} of {count} eigenvalues in ({low}, {high}]")
        size = min(d, 2 * size)


def components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as rows.

    Fewer where the covariance has fewer eigenvalues above rounding. The entry of largest
    size of each vector is positive.
    """
    d = len(covariance)
    covariance = (covariance + covariance.T) / 2
    if not d or not covariance.any():
        return np.zeros(0), np.zeros((0, d))
    spectrum = Spectrum(covariance)
    k = min(k, spectrum.above(d * EPS * spectrum.scale))
    values, vectors = [], []
    for low, high, count in spectrum.intervals(k):
        e, v = project(covariance, low, high, count)
        values.extend(e[::-1])
        vectors.extend(v.T[::-1])
    signs = [np.copysign(1.0, v[np.abs(v).argmax()]) for v in vectors[:k]]
    rows = [s * v / np.linalg.norm(v) for s, v in zip(signs, vectors[:k])]
    return np.array(values[:k]), np.array(rows).reshape(k, d)


# -- moments in Spark --------------------------------------------------------------------


def steps(vector: str | Column, scale: int) -> Column:
    """Entries as whole steps ``floor(scale * entry)``; null for a vector that has none.

    That is a null vector, or one with an entry that is null, not finite, or too large for
    a long.
    """
    v = F.col(vector) if isinstance(vector, str) else vector
    v = F.transform(v, lambda c: c.cast("double") * scale)
    # forall skips no null: a null entry makes it null, which is not true
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    return F.when(good, F.transform(v, lambda c: F.floor(c)))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A batch of vectors of ``d`` entries as rows of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _sum_of_products(fit: DataFrame, d: int, rows_of: Callable[[np.ndarray], np.ndarray], width: int):
    """Sum over the rows of ``fit`` of ``r rT``, ``r`` being ``rows_of`` the vector.

    Every task sends one partial row per row of the result, which Spark adds up.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                r = rows_of(matrix(batch.column(0), d))
                total += r.T @ r
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                ["i", "row"],
            )

    sent = fit.select("x").mapInArrow(partial, "i int, row array<double>")
    adding = (
        f"aggregate(collect_list(row), array_repeat(0D, {width}),"
        " (s, r) -> zip_with(s, r, (a, b) -> a + b))"
    )
    out = np.zeros((width, width))
    for i, row in sent.groupBy("i").agg(F.expr(adding).alias("row")).collect():
        out[i] = row
    return out


def whiten(
    vectors: DataFrame, id_col: str, vector_col: str, k: int, scale: int = 256
) -> DataFrame:
    """Every vector on the ``k`` leading components, scaled to unit variance.

    Entries are rounded down to steps of ``1/scale``, which makes vectors comparable
    exactly. Mean and covariance are those of the distinct vectors. One row per vector and
    component: ``id_col``, ``component`` (1 has the largest variance), ``n`` (distinct
    vectors), ``deviation`` (exact squared distance of ``n`` times the vector from the sum
    of all; null beyond a long), ``whitened``, ``explained`` (share of the variance) and
    ``identity_error`` (how far the covariance of the whitened vectors is from identity).

    Vectors that are null or hold entries that are null, not finite or beyond a long are
    left out. The dimension is that of most vectors (ties: the larger); vectors of another
    length are left out too. Repeated ids and null ids are kept as they are. Components
    without variance do not exist, so equal vectors, a single one or an empty table give no
    rows. Other columns of ``vectors`` are not read, whatever their names; an ``id_col``
    named like a result raises ``ValueError``.

    The driver holds the covariance and its solves: about 100 bytes times the square of
    the dimension, whatever the number of vectors.
    """
    results = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    if id_col in results:
        raise ValueError(f"id column {id_col!r} is the name of a result")
    spark = vectors.sparkSession
    id_type = vectors.select(id_col).schema[0].dataType.simpleString()
    schema = (
        f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double"
    )
    rows = vectors.select(F.col(id_col), steps(vector_col, scale).alias("x"))
    rows = rows.filter("x IS NOT NULL AND size(x) > 0")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], schema)
    d = length["d"]
    rows = rows.filter(F.size("x") == d)
    fit = stored(rows.select("x").distinct(), "vectors")

    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(20,0)")).alias("s"),
        F.max(F.abs("v")).alias("most"),
        F.count("*").alias("n"),
    )
    got = sorted(sums.collect())
    n, most = got[0]["n"], max(r["most"] for r in got)
    total = np.array([int(r["s"]) for r in got], object)
    small = d * (2 * n * most) ** 2 < 2**62
    if small:
        total = total.astype(np.int64)
    mean = np.array([float(s) / n for s in total])

    def centred(x: np.ndarray) -> np.ndarray:
        return x - mean

    covariance = _sum_of_products(fit, d, centred, d) / n
    values, axes = components(covariance, k)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    turned = (axes / np.sqrt(values)[:, None]).T
    explained = [float(e) for e in values / np.trace(covariance)]
    # a column of ones gives the sums of the whitened vectors beside their products
    second = _sum_of_products(
        fit, d, lambda x: np.hstack(((x - mean) @ turned, np.ones((len(x), 1)))), k + 1
    )
    middle = second[:k, k] / n
    error = float(np.abs(second[:k, :k] / n - np.outer(middle, middle) - np.eye(k)).max())

    def deviations(x: np.ndarray) -> pa.Array:
        if small:
            return pa.array(((n * x - total) ** 2).sum(1), pa.int64())
        exact = ((n * x.astype(object) - total) ** 2).sum(1)
        return pa.array([v if v < 2**63 else None for v in exact], pa.int64())

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = matrix(batch.column(1), d)
            again = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(again),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    deviations(x).take(again),
                    pa.array((centred(x) @ turned).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [id_col, *results],
            )

    return rows.mapInArrow(project_rows, schema)
