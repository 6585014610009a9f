"""Whitening of vectors by their principal components, found by spectral divide-and-conquer.

Components of a vector become whole numbers, ``floor(64 * c) + 1000000``, so that sums are exact. Tasks sum the distinct vectors, then the
products of their exact deviations from the mean; a covariance matrix of ``dims * dims`` values is all that reaches the driver. There the
matrix is split: the polar factor of the matrix less a shift (QDWH, dynamically weighted Halley steps by QR, later by Cholesky) has the
eigenvalues +1 and -1, so it gives the projector on the subspace above the shift; orthonormal bases of that subspace and its complement split the matrix into
two smaller ones, until each is a component. The components go to every task, which projects its rows.

Defined results: null and empty vectors and those with null or non-finite entries are dropped, and so are vectors of another length than most
(the longer, if two lengths are as frequent); null ids and repeated rows are kept, and equal vectors are fitted once. Scaled entries are
held to 2**27. Components whose variance is zero to rounding are left out, so equal vectors alone give no rows; a deviation beyond a long is null;
an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch
from coursemill.llm.sliced import fit, whole_numbers

SHIFT = 1_000_000
COMPONENTS = 16
_EPS = np.finfo(np.float64).eps
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def polar(a: np.ndarray, steps: int = 30) -> np.ndarray | None:
    """The orthogonal polar factor of a square matrix; None where the matrix is singular to rounding."""
    size = len(a)
    x = a / np.linalg.norm(a)
    try:
        least = 1 / np.linalg.norm(np.linalg.inv(x))  # no singular value is smaller
    except np.linalg.LinAlgError:
        return None
    if not least > 4 * size * _EPS:
        return None
    for _ in range(steps):
        square = min(least, 1.0) ** 2
        d = np.cbrt(4 * (1 - square) / square**2)
        wa = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(size)]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:size] @ q[size:].T
        else:
            low = np.linalg.cholesky(np.eye(size) + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(low.T, np.linalg.solve(low, x.T)).T
        moved, x = np.linalg.norm(new - x), new
        least = min(1.0, least * (wa + wb * square) / (1 + wc * square))
        if 1 - least < 10 * _EPS and moved < np.cbrt(_EPS):
            return x
    return x


def _bases(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces above and below the shift; None if there is nothing on one side, or the shift is an eigenvalue."""
    size = len(a)
    sign = polar(a - shift * np.eye(size))
    if sign is None:
        return None
    projector = (np.eye(size) + (sign + sign.T) / 2) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < size:
        return None
    q, _ = np.linalg.qr(projector @ np.random.default_rng(3).normal(size=(size, size)))
    above, _ = np.linalg.qr(projector @ q[:, :rank])
    rest = q[:, rank:] - projector @ q[:, rank:]
    below, _ = np.linalg.qr(rest - above @ (above.T @ rest))
    return above, below


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors, as columns, of a symmetric matrix."""
    scale, found = np.linalg.norm(a), []
    todo = [((a + a.T) / 2, np.eye(len(a)))]
    while todo:
        part, basis = todo.pop()
        size, middle = len(part), float(np.trace(part)) / len(part)
        spread = np.linalg.norm(part - middle * np.eye(size))
        if size == 1 or spread <= 4 * size * _EPS * scale:  # one component, or equal eigenvalues: any basis will do
            found += [(part[i, i], basis[:, i]) for i in range(size)]
            continue
        split, left = None, np.inf  # there is an eigenvalue on both sides of the mean, but it may lie on the shift
        for step in (0.0, 0.1, -0.1, 0.037, -0.023):
            tried = _bases(part, middle + step * spread / size)
            if tried is not None and (rest := np.linalg.norm(tried[1].T @ part @ tried[0])) < left:
                split, left = tried, rest
                if left <= 4 * size * _EPS * scale:
                    break
        if split is None:
            raise ArithmeticError("no shift splits the matrix")
        for side in split:
            inner = side.T @ part @ side
            todo.append(((inner + inner.T) / 2, basis @ side))
    found.sort(key=lambda x: -x[0])
    values, vectors = np.array([v for v, _ in found]), np.array([x for _, x in found]).reshape(len(a), -1).T
    return values, vectors / np.linalg.norm(vectors, axis=0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("x").flatten(), np.int64).reshape(batch.num_rows, -1)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of a task's vectors at place -1, then their sum by dimension."""
    total = 0
    for batch in batches:
        if batch.num_rows:
            total = total + np.r_[batch.num_rows, _matrix(batch).sum(0)]
    if np.ndim(total):
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)) - 1, pa.int32()), pa.array(total)], names=["i", "v"])


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return n * x - total


def _products(n: int, total: np.ndarray, weights: np.ndarray):
    """A task's sum of products of centred rows, projected by ``weights``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((weights.shape[1],) * 2)
        for batch in batches:
            if batch.num_rows:
                z = (_deviations(_matrix(batch), n, total) / n) @ weights
                held += z.T @ z
        if held.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(held.size), pa.int32()), pa.array(held.reshape(-1))], names=["i", "v"])

    return rows


def _covariance(rows: DataFrame, n: int, total: np.ndarray, weights: np.ndarray) -> np.ndarray:
    sums = rows.mapInArrow(_products(n, total, weights), "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(weights.shape[1] ** 2)  # as long as the matrix, whatever the table
    out[sums["i"].to_numpy(np.int64)] = sums["v"].to_numpy(np.float64)
    return out.reshape(weights.shape[1], -1) / n


def _projected(n: int, total: np.ndarray, weights: np.ndarray, explained: np.ndarray, error: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = len(explained)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                d = _deviations(_matrix(part), n, total)
                fits = (d.astype(np.float64) ** 2).sum(1) < 2.0**63 - 2.0**20
                squares = pa.array((np.where(fits[:, None], d, 0) ** 2).sum(1), mask=~fits)
                row = np.repeat(np.arange(part.num_rows), some)
                columns = [
                    part.column("vec_id").take(pa.array(row)), pa.array(np.tile(np.arange(1, some + 1), part.num_rows), pa.int32()), pa.array(np.full(len(row), n)),
                    squares.take(pa.array(row)), pa.array((d / n @ weights).reshape(-1)), pa.array(np.tile(explained, part.num_rows)), pa.array(np.full(len(row), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each row of ``vectors`` (``vec_id, embedding``) and each of the ``most`` first components."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "whitening")
    x = F.transform(whole_numbers(F.col("embedding")), lambda c: c + SHIFT)
    rows = vectors.filter(fit(F.col("embedding"))).select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))
    common = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return spark.createDataFrame([], _OUT)
    rows = rows.filter(F.size("x") == common["dims"])
    fitted = scratch.keep(rows.select("x").distinct(), "fitted")
    sums = {r["i"]: r["v"] for r in fitted.mapInArrow(_totals, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).collect()}  # dims + 1 rows
    n, total = sums[-1], np.array([sums[i] for i in range(common["dims"])], np.int64)
    v = _covariance(fitted, n, total, np.eye(common["dims"]))
    values, vectors_ = components(v)
    whole = int((values[:most] > 8 * len(values) * _EPS * max(values[0], 0)).sum())
    if not whole:
        return spark.createDataFrame([], _OUT)
    weights = vectors_[:, :whole] / np.sqrt(values[:whole])
    error = float(np.abs(_covariance(fitted, n, total, weights) - np.eye(whole)).max())
    return rows.mapInArrow(_projected(n, total, weights, values[:whole] / np.trace(v), error), _OUT)
