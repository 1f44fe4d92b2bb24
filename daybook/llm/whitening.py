"""Whitening of embeddings by the leading components of their covariance.

Tasks add up sums and then centred products, a square matrix of the vectors' length
per partition; the driver gets that one matrix, makes it tridiagonal by Householder
reflections, brackets the leading eigenvalues by Sturm counts and finds their
vectors by inverse iteration, orthogonal anew within clusters of close values. The
components go to the tasks as a constant and every vector is projected on them.

Defined results: vectors that are null, empty, or hold a null or non-finite entry, or
one whose scaled value is no long, are left out, as are vectors of another length than
most (the longer of equally frequent lengths); repeated rows count each time.
Components whose eigenvalue is nothing beside the trace are left out, so that equal
vectors, like an empty table, give no rows. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components that are kept at most.
COMPONENTS = 8
#: Entries become floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Eigenvalues closer than this share of the largest are one cluster; below this share of the trace one is nothing.
CLUSTER, NOTHING = 1e-3, 1e-12
_LARGEST = 2.0**62


# --- eigenvectors of one symmetric matrix --------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections that make a symmetric matrix tridiagonal."""
    a = np.array(matrix, float)
    n, off, mirrors = len(a), np.zeros(max(0, len(a) - 1)), []
    for k in range(n - 1):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        off[k] = -np.copysign(norm, v[0])
        v[0] -= off[k]
        length = np.linalg.norm(v)
        v = v / length if length > 0 else np.zeros_like(v)
        p = a[k + 1 :, k + 1 :] @ v
        w = p - (v @ p) * v
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    return np.diag(a).copy(), off, mirrors


def values_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each of some numbers (Sturm's count)."""
    least = np.finfo(float).tiny / np.finfo(float).eps
    count, q = np.zeros(len(x), int), np.ones(len(x))
    for i in range(len(d)):
        q = d[i] - x - (e[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def largest_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bracketed until no number lies between."""
    n = len(d)
    reach = np.concatenate(([0.0], np.abs(e), [0.0]))
    radius = reach[:-1] + reach[1:]
    low, high = np.full(k, (d - radius).min()), np.full(k, (d + radius).max())
    margin = np.finfo(float).eps * max(1.0, np.abs(low).max(), np.abs(high).max())
    low, high, rank = low - margin, high + margin, n - 1 - np.arange(k)
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = values_below(d, e, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of (T - shift) x = b by elimination with row exchanges."""
    n = len(d)
    rows = np.zeros((n, 3))
    rhs = b.copy()
    current = np.array([d[0] - shift, e[0] if n > 1 else 0.0, 0.0])
    for i in range(n - 1):
        below = np.array([e[i], d[i + 1] - shift, e[i + 1] if i + 2 < n else 0.0])
        if abs(below[0]) > abs(current[0]):
            current, below = below, current
            rhs[i], rhs[i + 1] = rhs[i + 1], rhs[i]
        if current[0] == 0:
            current[0] = tiny
        factor = below[0] / current[0]
        rows[i] = current
        rhs[i + 1] -= factor * rhs[i]
        current = np.array([below[1] - factor * current[1], below[2] - factor * current[2], 0.0])
    rows[n - 1] = current
    if abs(rows[n - 1, 0]) < tiny:
        rows[n - 1, 0] = tiny
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        x[i] = (rhs[i] - rows[i, 1] * x[i + 1] - rows[i, 2] * x[i + 2]) / rows[i, 0]
        if abs(x[i]) > 1e200:  # only the direction counts
            scale = abs(x[i])
            x /= scale
            rhs /= scale
    return x[:n]


def leading_components(matrix: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    The entry of a vector that is largest in size is positive.
    """
    n = len(matrix)
    d, e, mirrors = tridiagonal(matrix)
    values = largest_values(d, e, min(k, n))
    size = max(np.abs(d).max(initial=0.0), np.abs(e).max(initial=0.0), np.finfo(float).tiny)
    tiny = np.finfo(float).eps * size
    rng, found, cluster = np.random.default_rng(0), [], 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * size:
            cluster = i
        x = rng.standard_normal(n)
        for _ in range(6):
            for other in found[cluster:]:
                x = x - (other @ x) * other
            x /= np.linalg.norm(x)
            x = _solve(d, e, value, x, tiny)
            x /= np.linalg.norm(x)
        for _ in range(2):
            for other in found[cluster:]:
                x = x - (other @ x) * other
            x /= np.linalg.norm(x)
        found.append(x)
    vectors = np.array(found).reshape(len(values), n)
    for k_, v in reversed(list(enumerate(mirrors))):
        part = vectors[:, k_ + 1 :]
        part -= 2 * np.outer(part @ v, v)
    # Rounding of the way back: orthogonal anew in falling order, values as the matrix has them.
    for i in range(len(vectors)):
        for j in range(i):
            vectors[i] -= (vectors[j] @ vectors[i]) * vectors[j]
        vectors[i] /= np.linalg.norm(vectors[i])
        vectors[i] *= np.sign(vectors[i][np.abs(vectors[i]).argmax()])
    return np.einsum("ij,jk,ik->i", vectors, matrix, vectors), vectors


# --- sums over all vectors -------------------------------------------------------------


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a batch whose vectors can be used, their lengths and offsets, and all entries scaled."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * SCALE)
    usable = np.isfinite(scaled) & (np.abs(np.where(np.isfinite(scaled), scaled, 0)) < _LARGEST)
    bad = np.concatenate(([0], np.cumsum(~usable)))
    offsets = np.cumsum(lengths) - lengths
    rows = np.flatnonzero((lengths > 0) & (bad[offsets + lengths] == bad[offsets]))
    entries = np.where(usable, scaled, 0).astype(np.int64) + SHIFT
    return rows, lengths[rows], offsets[rows], entries


def _matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that hold a usable vector of this length, and these vectors."""
    rows, lengths, offsets, entries = _vectors(column)
    fits = lengths == length
    return rows[fits], entries[offsets[fits][:, None] + np.arange(length)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        _, lengths, offsets, entries = _vectors(batch.column(0))
        for length in np.unique(lengths).tolist():
            at = offsets[lengths == length]
            total = totals.setdefault(length, [0, np.zeros(length, np.int64)])
            total[0] += len(at)
            total[1] += entries[at[:, None] + np.arange(length)].sum(axis=0)
    for length, (n, sums) in totals.items():
        yield pa.RecordBatch.from_pydict(
            {"length": np.full(length, length), "place": np.arange(length), "n": np.full(length, n), "total": sums}
        )


@dataclass(frozen=True)
class Centre:
    """Number and sums of the vectors of the fit list."""

    n: int
    sums: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Vectors less the mean: whole numbers first, which is exact, then what is left of the mean."""
        return (x - self.sums // self.n).astype(float) - (self.sums % self.n) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - sums) ** 2, exact."""
        if np.abs(x.astype(float)).max(initial=0) * self.n < _LARGEST and np.abs(self.sums.astype(float)).max() < _LARGEST:
            apart = self.n * x - self.sums
            if (np.abs(apart.astype(float)).max(initial=0) ** 2) * len(self.sums) < _LARGEST:
                return (apart**2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - self.sums.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def centre(vectors: DataFrame, column: str) -> Centre | None:
    """Number and sums of the usable vectors of the most frequent length."""
    sums = (
        vectors.select(column)
        .mapInArrow(_sums, "length long, place long, n long, total long")
        .groupBy("length", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .collect()  # a row for each place of a vector
    )
    if not sums:
        return None
    _, length = max((r["n"], r["length"]) for r in sums)
    totals = sorted((r["place"], r["total"], r["n"]) for r in sums if r["length"] == length)
    return Centre(totals[0][2], np.array([t for _, t, _ in totals], np.int64))


def _products(of: Callable[[np.ndarray], np.ndarray], length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of products of each two places of what ``of`` makes of the vectors, and sums of each place."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = 0, 0
        for batch in batches:
            rows, x = _matrix(batch.column(0), length)
            if len(rows):
                y = of(x)
                total, first = total + y.T @ y, first + y.sum(axis=0)
        if not np.isscalar(total):
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict(
                {
                    "i": np.concatenate((i, np.full(len(first), -1))),
                    "j": np.concatenate((j, np.arange(len(first)))),
                    "total": np.concatenate((total[i, j], first)),
                }
            )

    return added


def _covariance(vectors: DataFrame, column: str, of: Callable[[np.ndarray], np.ndarray], centre: Centre, size: int) -> np.ndarray:
    """Covariance of what ``of`` makes of the vectors; ``size`` ** 2 numbers come to the driver."""
    found = (
        vectors.select(column)
        .mapInArrow(_products(of, len(centre.sums)), "i long, j long, total double")
        .groupBy("i", "j")
        .agg(F.sum("total").alias("total"))
        .collect()
    )
    matrix, first = np.zeros((size, size)), np.zeros(size)
    for r in found:
        if r["i"] < 0:
            first[r["j"]] = r["total"]
        else:
            matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["total"]
    mean = first / centre.n  # of centred vectors: what rounding leaves
    return matrix / centre.n - np.outer(mean, mean)


@dataclass(frozen=True)
class Whitening:
    """Components of the fit list and what they explain."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening by all usable vectors; None if there are none or all are equal."""
    middle = centre(vectors, column)
    if middle is None:
        return None
    matrix = _covariance(vectors, column, middle.centred, middle, len(middle.sums))
    trace = float(np.trace(matrix))
    if not trace > 0:
        return None
    values, rows = leading_components(matrix, components)
    there = values > NOTHING * trace
    return Whitening(middle, values[there], rows[there], trace)


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, out: str = "whitened") -> DataFrame:
    """``vectors`` with the array ``out`` of their projections on the components, each of variance 1.

    Null where the vector takes no part.
    """
    model = fit(vectors, column, components)
    if model is None:
        return vectors.withColumn(out, F.lit(None).cast("array<double>"))

    @F.pandas_udf("array<double>")
    def projected(v: pd.Series) -> pd.Series:
        rows, x = _matrix(pa.array(v, pa.list_(pa.float64()), from_pandas=True), len(model.centre.sums))
        result = [None] * len(v)
        for row, values in zip(rows.tolist(), model.project(x), strict=True):
            result[row] = values
        return pd.Series(result, dtype=object)

    return vectors.withColumn(out, projected(F.col(column).cast("array<double>")))


DIGEST = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def digest(vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row for each usable vector and component, with its whitened value and how well the whole fits."""
    spark = vectors.sparkSession
    model = fit(vectors, column)
    if model is None:
        return spark.createDataFrame([], DIGEST)
    k, length, centre_ = len(model.values), len(model.centre.sums), model.centre
    spread = _covariance(vectors, column, model.project, centre_, k)
    error = float(np.abs(spread - np.eye(k)).max())
    explained = model.values / model.trace

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _matrix(batch.column(1), length)
            times = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pc.cast(batch.column(0), pa.int64()).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), times)),
                    pa.array(np.full(times * k, centre_.n)),
                    pa.array(centre_.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(times), k))),
                    pa.array(model.project(x).reshape(-1)),
                    pa.array(np.tile(explained, times)),
                    pa.array(np.full(times * k, error)),
                ],
                names=[c.split()[0] for c in DIGEST.split(", ")],
            )

    return vectors.select(vec_id, column).mapInArrow(rows_of, DIGEST)
