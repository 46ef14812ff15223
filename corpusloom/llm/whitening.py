"""Whitening of vectors: distributed covariance, tridiagonal eigenproblem, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPS = np.finfo(float).eps
#: Whole numbers are held within this, so that differences of two fit a long.
_HELD = 2.0**61
_LONGEST = 2**63 - 1


# --- the eigenproblem of one small symmetric matrix ----------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix; row k of ``reflectors`` is the k-th unit Householder vector."""
    a = np.array(matrix, float)
    d = len(a)
    reflectors = np.zeros((max(d - 2, 0), d))
    for k in range(d - 2):
        x = a[k + 1 :, k]
        size = np.abs(x[1:]).max()
        if size == 0:
            continue  # this column is tridiagonal already
        scale = max(size, abs(x[0]))
        v = x / scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        reflectors[k, k + 1 :] = v
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = p - (v @ p) * v
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each of ``at``: negative terms of the Sturm sequence."""
    tiny = np.finfo(float).tiny / _EPS
    squares = np.append(0.0, off * off)
    below = np.zeros(len(at), int)
    q = np.ones(len(at))
    for a, b2 in zip(diagonal, squares, strict=True):
        q = a - at - b2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected until its interval cannot be halved."""
    d = len(diagonal)
    radius = np.append(np.abs(off), 0.0) + np.append(0.0, np.abs(off))
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    slack = _EPS * d * max(abs(low), abs(high)) + np.finfo(float).tiny
    lo, hi = np.full(count, low - slack), np.full(count, high + slack)
    rank = d - 1 - np.arange(count)  # so many eigenvalues are smaller
    for _ in range(2_200):  # more halvings than doubles have between two of them
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        right = count_below(diagonal, off, mid) <= rank
        lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)
    return np.maximum.accumulate((lo + (hi - lo) / 2)[::-1])[::-1]


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float, right: np.ndarray) -> np.ndarray:
    """x with (T - shift) x = right, by elimination with row exchanges; no pivot is smaller than ``floor``."""
    d = len(diagonal)
    rows = [[0.0, diagonal[k] - shift, off[k] if k < d - 1 else 0.0, 0.0] for k in range(d)]
    x = right.copy()
    for k in range(d - 1):
        upper, lower = rows[k], [0.0, off[k], rows[k + 1][1], rows[k + 1][2]]
        if abs(lower[1]) > abs(upper[1]):
            upper, lower = lower, upper
            x[k], x[k + 1] = x[k + 1], x[k]
        if abs(upper[1]) < floor:
            upper[1] = floor
        f = lower[1] / upper[1]
        rows[k], rows[k + 1] = upper, [0.0, lower[2] - f * upper[2], lower[3] - f * upper[3], 0.0]
        x[k + 1] -= f * x[k]
    for k in range(d - 1, -1, -1):
        _, a, b, c = rows[k]
        rest = x[k] - (b * x[k + 1] if k + 1 < d else 0.0) - (c * x[k + 2] if k + 2 < d else 0.0)
        x[k] = rest / (a if abs(a) >= floor else floor)
    return x


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Unit eigenvectors (rows) of falling ``values`` by inverse iteration.

    Values closer than a thousandth of the norm form a cluster: there each iterate
    is made orthogonal to the vectors before it, twice, and shifts that agree to
    the last digits are moved apart.
    """
    d = len(diagonal)
    norm = max(float(np.abs(diagonal).max() + 2 * (np.abs(off).max() if len(off) else 0.0)), np.finfo(float).tiny)
    floor, near = _EPS * norm, 1e-3 * norm
    rng = np.random.default_rng(seed)
    found: list[np.ndarray] = []
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > near:
            first = k
        shift = min(float(value), shift - 10 * floor) if k > first else float(value)
        x = rng.standard_normal(d)
        for _ in range(6):
            x = _solve(diagonal, off, shift, floor, x / np.sqrt(x @ x))
            x /= np.abs(x).max()
            for _ in range(2):
                for y in found[first:k]:
                    x -= (x @ y) * y
            x /= np.sqrt(x @ x)
        found.append(x)
    return np.array(found).reshape(len(values), d)


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the ``count`` largest eigenvalues, falling; each vector's largest entry is positive."""
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, count)
    vectors = eigenvectors(diagonal, off, values)
    for v in reflectors[::-1]:
        vectors -= 2 * np.outer(vectors @ v, v)
    # one pass over the matrix itself takes out what rounding left between close ones
    for k in range(count):
        for j in range(k):
            vectors[k] -= (vectors[k] @ vectors[j]) * vectors[j]
        vectors[k] /= np.sqrt(vectors[k] @ vectors[k])
    values = np.einsum("kd,de,ke->k", vectors, np.asarray(matrix, float), vectors)
    sign = np.where(vectors[np.arange(count), np.abs(vectors).argmax(axis=1)] < 0, -1.0, 1.0) if count else np.empty(0)
    return values, vectors * sign[:, None]


# --- distributed sums -----------------------------------------------------------------


def _usable(vector: Column) -> Column:
    entries = F.transform(vector, lambda x: x.cast("double"))
    return F.coalesce(~F.exists(entries, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def _whole(vectors: pd.Series, scale: float, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole-number matrix) per length of the vectors of a batch."""
    sizes = np.fromiter((len(v) for v in vectors), int, len(vectors))
    values = vectors.to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        with np.errstate(over="ignore"):
            x = np.floor(scale * np.stack(values[at]).astype(float))
        yield at, np.clip(x, -_HELD, _HELD).astype(np.int64) + shift


_MASK = 0xFFFFFFFF


def _sums(df: DataFrame, scale: float, shift: int) -> dict[int, tuple[int, list[int]]]:
    """Per length: (rows, exact sums).  Halves of 32 bits are summed apart, so no sum leaves a long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for pdf in batches:
            for at, x in _whole(pdf["v"], scale, shift):
                held = total.setdefault(x.shape[1], [0, 0, 0])
                held[0] += len(at)
                held[1] = held[1] + (x >> 32).sum(axis=0)
                held[2] = held[2] + (x & _MASK).sum(axis=0)
        for dim, (n, high, low) in total.items():
            yield pd.DataFrame({"dim": dim, "i": np.arange(dim), "n": n, "high": high, "low": low})

    rows = df.select("v").mapInPandas(run, "dim int, i int, n long, high long, low long")
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows.groupBy("dim", "i").agg(F.sum("n").alias("n"), *whole).orderBy("dim", "i").collect():
        out.setdefault(r.dim, (r.n, []))[1].append((int(r.high) << 32) + int(r.low))
    return out


@dataclass(frozen=True)
class Centre:
    """A mean S / n kept exactly: ``near`` is the closest whole number, ``rest`` = S - n * near."""

    n: int
    near: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, sums: list[int]) -> Centre:
        near = [(2 * s + n) // (2 * n) for s in sums]
        return Centre(n, np.array(near, np.int64), np.array([s - n * m for s, m in zip(sums, near, strict=True)], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (x - self.near).astype(float) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None where a long cannot hold it."""
        y = x - self.near
        about = ((y.astype(float) * self.n - self.rest) ** 2).sum(axis=1)
        with np.errstate(over="ignore"):  # wraps round, so what fits a long is exact
            wrapped = ((np.int64(self.n) * y - self.rest) ** 2).sum(axis=1)
        out: list[int | None] = wrapped.tolist()
        for k in np.flatnonzero(about > 2.0**62):
            exact = sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(y[k], self.rest, strict=True))
            out[k] = exact if exact <= _LONGEST else None
        return out


def _products(df: DataFrame, rows_of, width: dict[int, int], scale: float, shift: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: (sums, sums of products) of ``rows_of(dim, x)``, added up in each task and then by place in Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for _, x in _whole(pdf["v"], scale, shift):
                dim = x.shape[1]
                if width.get(dim):
                    z = rows_of(dim, x)
                    z = np.column_stack([np.ones(len(z)), z])
                    total[dim] = total.get(dim, 0.0) + z.T @ z
        for dim, p in total.items():
            i, j = np.triu_indices(len(p))
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "p": p[i, j]})

    rows = df.select("v").mapInPandas(run, "dim int, i int, j int, p double")
    out = {dim: np.zeros((k + 1, k + 1)) for dim, k in width.items() if k}
    for r in rows.groupBy("dim", "i", "j").agg(F.sum("p").alias("p")).collect():
        out[r.dim][r.i, r.j] = out[r.dim][r.j, r.i] = r.p
    return {dim: (p[0, 1:], p[1:, 1:]) for dim, p in out.items()}


@dataclass(frozen=True)
class Whitening:
    """What is known of the vectors of one length: ``components`` are rows, ``explained`` their shares of the trace."""

    centre: Centre
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components.T / np.sqrt(self.values)


def fit(df: DataFrame, vector: str = "embedding", count: int = 32, scale: float = 64, shift: int = 1_000_000) -> dict[int, Whitening]:
    """One whitening per vector length, from all usable rows of ``df``, which is read twice.

    The first pass sums whole numbers exactly, the second multiplies centred ones;
    a task sends d^2 / 2 partial sums, whatever its rows.  The matrix is of the size
    of a vector, so its eigenproblem is solved on the driver: Householder
    tridiagonalisation, Sturm counts and bisection for the ``count`` largest
    eigenvalues, inverse iteration for their vectors.
    """
    rows = df.filter(_usable(F.col(vector)) & (F.size(vector) > 0)).select(F.col(vector).alias("v"))
    centres = {dim: Centre.of(n, sums) for dim, (n, sums) in _sums(rows, scale, shift).items()}
    sent = df.sparkSession.sparkContext.broadcast(centres)  # two whole numbers per place of a vector
    products = _products(rows, lambda dim, x: sent.value[dim].centred(x), {d: d for d in centres}, scale, shift)
    out = {}
    for dim, centre in centres.items():
        # centred before multiplying; what is left of the mean is rounding
        means, covariance = products[dim][0] / centre.n, products[dim][1] / centre.n
        covariance = covariance - np.outer(means, means)
        trace = float(np.trace(covariance))
        values, components = leading_components(covariance, min(count, dim)) if trace > 0 else (np.empty(0), np.empty((0, dim)))
        real = values > 4 * dim * _EPS * trace  # below, an eigenvalue is rounding: the vectors do not span this direction
        out[dim] = Whitening(centre, values[real], components[real], values[real] / (trace or 1.0))
    return out


def identity_errors(df: DataFrame, model: dict[int, Whitening], vector: str = "embedding", scale: float = 64, shift: int = 1_000_000) -> dict[int, float]:
    """Per length: the largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""
    rows = df.filter(_usable(F.col(vector)) & (F.size(vector) > 0)).select(F.col(vector).alias("v"))
    sent = df.sparkSession.sparkContext.broadcast(model)
    products = _products(rows, lambda dim, x: sent.value[dim].apply(x), {d: len(m.values) for d, m in model.items()}, scale, shift)
    out = {}
    for dim, (sums, p) in products.items():
        n = model[dim].centre.n
        means = sums / n
        out[dim] = float(np.abs(p / n - np.outer(means, means) - np.eye(len(p))).max())
    return out


RESULT = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def whiten(df: DataFrame, vector: str = "embedding", count: int = 32, scale: float = 64, shift: int = 1_000_000) -> DataFrame:
    """Rows whose vector is usable, whitened: (row, n, deviation, whitened, explained, identity_error).

    Entries become floor(``scale`` * c) + ``shift``; all covariances have divisor n.
    ``whitened`` holds x - S / n on up to ``count`` components, by falling
    eigenvalue e, over the root of e; ``explained`` is e / trace, ``deviation`` the
    exact sum of (n x - S)^2, ``identity_error`` one value for all rows.  The model (32 vectors of the rows' own length and their means) is broadcast.

    ``df`` is read four times: sums, products, the whitened rows' covariance, the result.
    Reading again is cheaper than a second copy of all vectors; give it a table.

    Rows whose vector is null or holds null or non-finite entries go.  Vectors of
    several lengths are whitened by length, each with its own n.  Directions that
    the rows do not span (eigenvalue at most rounding of the trace) are no
    components, so one row, equal rows or empty vectors (whose n is null) give empty
    arrays and a null ``identity_error``.  Whole numbers beyond 2^61 are held there; a deviation that a long
    cannot hold is null.  Repeated rows and rows without an id count like others;
    ties in e give any basis, the same for all rows; the columns of ``df`` stay in
    ``row``, so names never clash; an empty table gives an empty result.
    """
    spark = df.sparkSession
    model = fit(df, vector, count, scale, shift)
    errors = identity_errors(df, model, vector, scale, shift) if any(len(m.values) for m in model.values()) else {}
    sent = spark.sparkContext.broadcast((model, errors))

    @F.pandas_udf(f"struct<{', '.join(x.replace(' ', ': ', 1) for x in RESULT.split(', '))}>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, error = sent.value
        for vectors in batches:
            n, deviation, whitened, explained, identity = ([None] * len(vectors) for _ in range(5))
            for at, x in _whole(vectors, scale, shift):
                m = known.get(x.shape[1])
                if m is None:  # of length 0: no dimension, nothing to whiten
                    for k in at:
                        deviation[k], whitened[k], explained[k] = 0, [], []
                    continue
                for k, dev, row in zip(at, m.centre.deviations(x), m.apply(x), strict=True):
                    n[k], deviation[k], whitened[k], explained[k], identity[k] = m.centre.n, dev, row, m.explained, error.get(x.shape[1])
            yield pd.DataFrame({"n": pd.array(n, "Int64"), "deviation": pd.array(deviation, "Int64"), "whitened": whitened, "explained": explained, "identity_error": identity})

    rows = df.filter(_usable(F.col(vector))).select(F.struct(*df.columns).alias("row"), F.col(vector).alias("v"))
    return rows.select("row", apply("v").alias("w")).select("row", "w.*")


def long_form(whitened: DataFrame, vec_id: str = "vec_id") -> DataFrame:
    """One row per vector and component (from 1): vec_id, component, n, deviation, whitened, explained, identity_error."""
    each = whitened.select(
        F.col("row")[vec_id].alias("vec_id"), "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c")
    )
    return each.select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
