"""Embedding whitening by spectrum slicing.

Entries c become the integers x = floor(256 c). Means and covariance are those of the distinct x vectors: sums are exact,
the covariance is centred before multiplying and added up from one partial matrix a task. On the covariance (dimension
squared entries, so bounded) each leading eigenvalue is isolated by inertia counts: the positive pivots of an LDL^T
factorisation of V - s I count the eigenvalues above s. Rayleigh quotient iteration then converges to the pair in that
interval, and counts on both sides of the found value certify that it is the k-th one.

Rows whose vector is null, empty, or holds null or non-finite entries are left out. Vectors of another length form a
table of their own: each length has its own means, components and n. There are min(COMPONENTS, length) components; one
without spread (a constant table, fewer distinct vectors than components) gives whitened and explained 0 and is left out of the
identity check. Repeated rows are each whitened, but count once in the fit. Entries beyond 2**55 are held at the ends of
64-bit integers; a deviation that does not fit a long is null. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import table
from tidemark.session import settle

COMPONENTS = 4
GRID = 256
_EPS = np.finfo(np.float64).eps
_PIVOT = (1 + 17 ** 0.5) / 8  # Bunch and Kaufman's bound for a one-by-one pivot
_RAYLEIGH_STEPS = 30


# --- spectrum slicing of one symmetric matrix -------------------------------------------------------------------------

def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of symmetric ``a`` above ``shift``: positive pivots of LDL^T of a - shift I."""
    m = a - shift * np.eye(len(a))
    n, k, positive = len(m), 0, 0
    while k < n:
        width = 1
        if k < n - 1:
            below = np.abs(m[k + 1:, k])
            r = k + 1 + int(below.argmax())
            most = below[r - k - 1]
            if abs(m[k, k]) < _PIVOT * most:
                row = np.abs(m[r, k:])
                row[r - k] = 0
                widest = row.max()
                if abs(m[k, k]) * widest < _PIVOT * most * most:
                    width = 1 if abs(m[r, r]) >= _PIVOT * widest else 2
                    to = k + width - 1
                    m[[to, r]] = m[[r, to]]
                    m[:, [to, r]] = m[:, [r, to]]
        rest = m[k + width:, k:k + width]
        if width == 2:
            positive += 1  # such a block has one eigenvalue of each sign
            m[k + 2:, k + 2:] -= rest @ np.linalg.solve(m[k:k + 2, k:k + 2], rest.T)
        elif m[k, k] != 0:
            positive += int(m[k, k] > 0)
            m[k + 1:, k + 1:] -= rest @ (rest.T / m[k, k])
        k += width
        m[k:, k:] = (m[k:, k:] + m[k:, k:].T) / 2  # rounding on one side alone could leave a singular block
    return positive


def _shifted_solve(a: np.ndarray, shift: float, v: np.ndarray, scale: float) -> np.ndarray:
    eye = np.eye(len(a))
    for nudge in (0.0, _EPS * scale, 16 * _EPS * scale):
        try:
            w = np.linalg.solve(a - (shift + nudge) * eye, v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all() and w.any():
            return w / np.abs(w).max()
    return v


def _unit(v: np.ndarray, found: np.ndarray) -> np.ndarray:
    """v without its parts along the found vectors, of length 1."""
    for _ in range(2):
        v = v - found @ (found.T @ v)
    return v / np.linalg.norm(v)


def _rayleigh(a: np.ndarray, low: float, high: float, found: np.ndarray, scale: float, seed: int) -> tuple[float, np.ndarray, float]:
    """An eigenpair near (low, high] and its residual: inverse iteration in the middle, then Rayleigh quotients."""
    v = _unit(np.random.default_rng(seed).standard_normal(len(a)), found)
    for _ in range(3):
        v = _unit(_shifted_solve(a, (low + high) / 2, v, scale), found)
    best = (0.0, v, np.inf)
    for _ in range(_RAYLEIGH_STEPS):
        value = float(v @ a @ v)
        residual = float(np.linalg.norm(a @ v - value * v))
        if residual >= best[2]:
            break
        best = (value, v, residual)
        v = _unit(_shifted_solve(a, value, v, scale), found)
    return best


def leading_pairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of symmetric ``a`` in falling order and their unit vectors as columns."""
    n = len(a)
    top = float(np.abs(a).sum(axis=1).max())  # no eigenvalue lies beyond it
    scale = top or 1.0
    values, vectors = np.zeros(0), np.zeros((n, 0))
    slack = 64 * n * _EPS * scale
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(a, shift)
        return counts[shift]

    for rank in range(1, k + 1):
        low, high = -top - slack, top + slack
        while True:
            while high - low > slack and not (above(low) == rank and above(high) == rank - 1):
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= rank else (low, middle)
            value, vector, residual = _rayleigh(a, low, high, vectors, scale, rank)
            if low - slack <= value <= high + slack and residual <= slack and above(value + 2 * slack) < rank <= above(value - 2 * slack):
                break  # certified; a neighbour at the edge of the interval is not
            if high - low <= slack:
                raise ArithmeticError(f"eigenvalue {rank} was not resolved")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= rank else (low, middle)
        values, vectors = np.append(values, value), np.column_stack([vectors, vector])
    return values, vectors


# --- fit over a table -------------------------------------------------------------------------------------------------

@dataclass
class Whitening:
    """Means and scaled components of the vectors of one length."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    axes: np.ndarray  # (length, components): unit vectors over the roots of their eigenvalues
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact: 64-bit arithmetic wraps, so it is right whenever the result fits."""
        with np.errstate(over="ignore"):
            exact = ((np.int64(self.n) * x - self.sums) ** 2).sum(axis=1)
        rough = ((float(self.n) * x - self.sums) ** 2).sum(axis=1)
        return [int(e) if r < 9.2e18 else None for e, r in zip(exact, rough)]


def on_grid(vector: Column) -> Column:
    """The integers floor(256 c) of a vector."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * GRID))


def usable(vector: Column) -> Column:
    """Neither null nor empty, and only finite entries."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of their vectors) for each length in a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, values[starts[at][:, None] + np.arange(d)]


def _add_up(fit_list: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> dict[int, np.ndarray]:
    """Sum of part(matrix) over all vectors of each length; one partial a task and length is shuffled, by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                d = x.shape[1]
                held[d] = held[d] + part(x) if d in held else part(x)
        for d, total in held.items():
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), d, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)),
                                              pa.array(flat)], ["d", "place", "value"])

    sums = fit_list.select("x").mapInArrow(run, f"d int, place int, value {kind}").groupBy("d", "place").agg(F.sum("value").alias("value"))
    out: dict[int, list] = {}
    for r in sums.collect():  # entries of one matrix for each length
        out.setdefault(r["d"], []).append((r["place"], r["value"]))
    return {d: np.asarray([v for _, v in sorted(entries)]) for d, entries in out.items()}


def fit(x_rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Whitening of each vector length from the distinct vectors of column ``x``."""
    fit_list = settle(x_rows.select("x").distinct(), "whitening-fit")
    totals = _add_up(fit_list, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    models: dict[int, Whitening] = {}
    means = {d: t[:-1] / t[-1] for d, t in totals.items()}

    def scatter(x: np.ndarray) -> np.ndarray:
        y = x - means[x.shape[1]]
        return y.T @ y

    for d, flat in _add_up(fit_list, scatter).items():
        n, sums = int(totals[d][-1]), totals[d][:-1]
        cov = flat.reshape(d, d) / n
        cov = (cov + cov.T) / 2
        values, vectors = leading_pairs(cov, min(components, d))
        trace = float(np.trace(cov))
        real = values > 64 * d * _EPS * max(trace, 1e-300)
        axes = np.where(real, vectors / np.sqrt(np.where(real, values, 1)), 0)
        models[d] = Whitening(n, sums, values, np.where(real, values / (trace or 1.0), 0), axes)

    def spread(x: np.ndarray) -> np.ndarray:
        z = models[x.shape[1]].project(x)
        return z.T @ z

    for d, flat in _add_up(fit_list, spread).items():
        model = models[d]
        k = len(model.values)
        real = np.flatnonzero(model.explained > 0)
        off = np.abs(flat.reshape(k, k) / model.n - np.eye(k))[np.ix_(real, real)]
        model.identity_error = float(off.max()) if off.size else 0.0
    return models


def whiten(x_rows: DataFrame, models: dict[int, Whitening], key: str = "vec_id") -> DataFrame:
    """One row per row of (key, x) and component."""
    held = x_rows.sparkSession.sparkContext.broadcast(models)  # one mean and a few axes for each vector length
    kind = x_rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch.column(1)):
                model = held.value[x.shape[1]]
                k, rows = len(model.values), len(at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array([v for v in model.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error))],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x_rows.select(key, "x").mapInArrow(
        run, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    vectors = table(spark, sf_dir, "embeddings")
    rows = vectors.where(usable(F.col("embedding"))).select("vec_id", on_grid(F.col("embedding")).alias("x"))
    return whiten(rows, fit(rows))
