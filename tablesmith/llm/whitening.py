"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred fit list X (a row per distinct vector) stays distributed. Each step alternates between two
products over it: Xv, of which only inner products with the earlier left vectors come back, and Xᵀ times
that. A left vector is never stored: u = Xw, and w has one entry per dimension, so a pass over the rows
gives it again. Both sides are made orthogonal to all earlier ones, again where much was taken away. The driver holds vectors of
one entry per dimension and the small bidiagonal matrix, whose SVD yields components and deviations.

The steps end when the wanted components have residuals at the level of rounding and what is left of
the trace is below the last of them, so no equal or larger eigenvalue can be missing; at the latest
when every dimension is used. A product that vanishes (equal eigenvalues, fewer vectors than
dimensions) restarts with a new direction.

Defined results:

* Rows whose vector is NULL, or holds a NULL, an infinite or NaN entry, or one whose 256-fold is not a
  long, are dropped. An empty vector is a vector without entries; a shorter vector than the longest
  counts as ending in zeros.
* Repeated vectors are in the fit list once and get their rows each. Equal eigenvalues: any base of
  their space. Components whose eigenvalue is zero (up to rounding) don't exist: a single vector has
  none, and no rows. An empty table gives an empty result.
* ``deviation`` is exact; where it does not fit a long, the job fails.
* Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import column_of, written

SCALE = 256
#: Rows that are multiplied together in one task.
HELD = 4096


@dataclass(frozen=True)
class Settings:
    components: int = 4
    seed: int = 13
    #: Residuals and vanished products, relative to the largest deviation.
    rounding: float = 1e-13

    def __post_init__(self):
        if self.components < 1:
            raise ValueError("components: 1 at least")


@dataclass(frozen=True)
class Whitening:
    """Components as rows of ``directions`` with their ``eigenvalues``; the fit list's size and sums."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``, the vector as longs, of all rows that have one."""
    bound = float(1 << 63) / SCALE

    def usable(c):
        return c.isNotNull() & ~F.isnan(c) & (c.cast("double") >= -bound) & (c.cast("double") < bound)

    fine = F.col("embedding").isNotNull() & F.forall("embedding", usable)
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))
    return embeddings.where(fine).select("vec_id", x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows with their vectors as a matrix of longs, filled with zeros."""
    for batch in batches:
        for at in range(0, batch.num_rows, HELD):
            part = batch.slice(at, HELD)
            x = column_of(part, "x")
            lengths = np.diff(np.asarray(x.offsets))
            values = np.asarray(x.flatten(), dtype=np.int64)
            rows = np.zeros((len(x), dims), np.int64)
            rows[np.arange(dims)[None, :] < lengths[:, None]] = values
            yield part, rows


def _summed(fit: DataFrame, dims: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of what ``of`` makes of a matrix of them: ``size`` numbers.

    Every task sends one array, and one task adds them place by place.
    """

    def parts(batches):
        total = np.zeros(size)
        for _, rows in _matrices(batches, dims):
            total += of(rows)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

    sums = fit.select("x").mapInArrow(parts, "part array<double>").repartition(1)
    sums = sums.select(F.posexplode("part").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    total = np.zeros(size)
    for i, v in sums.collect():
        total[i] = v
    return total


class _Bidiagonal:
    """The growing factorisation X V = U B, with U = X W never stored."""

    def __init__(self, product: Callable, dims: int, settings: Settings):
        self.product, self.dims, self.settings = product, dims, settings
        self.right: list[np.ndarray] = []
        self.left: list[np.ndarray] = []  # w of u = Xw
        self.back: list[np.ndarray] = []  # Xᵀu
        self.alpha: list[float] = []
        self.beta: list[float] = []
        self.random = np.random.default_rng(settings.seed)
        self.size = 0.0

    def _fresh(self) -> np.ndarray:
        """A direction orthogonal to all right vectors."""
        return self._orthogonal(self.random.standard_normal(self.dims))

    def _orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(3):
            for other in self.right:
                v = v - other * (other @ v)
            norm = np.linalg.norm(v)
            v = v / norm if norm else v
        return v

    def step(self) -> None:
        if not self.right:
            self.right.append(self._fresh())
        v, k = self.right[-1], len(self.left)
        # Xv and Xᵀ(Xv) in one pass over the rows, and what of Xv lies along earlier left vectors.
        z, along, norm2 = self._product(v)
        w, z = self._freed(v, z, along)
        alpha = float(np.sqrt(max(norm2 - along @ along, 0.0)))
        if self.settings.rounding * self.size < alpha:
            w, z = w / alpha, z / alpha
            if alpha < 0.7 * np.sqrt(norm2):
                # Much was taken away: once more, from what is left.
                z, along, norm2 = self._product(w)
                w, z = self._freed(w, z, along)
                length = float(np.sqrt(max(norm2 - along @ along, 0.0)))
                alpha = alpha * length
                if length:
                    w, z = w / length, z / length
        self.size = max(self.size, alpha)
        if alpha <= self.settings.rounding * self.size:
            # Nothing of X is left along v.
            w, z, alpha = np.zeros(self.dims), np.zeros(self.dims), 0.0
        self.left.append(w)
        self.back.append(z)
        self.alpha.append(alpha)
        if k + 1 == self.dims:
            self.beta.append(0.0)
            return
        rest = z - alpha * v
        for _ in range(2):
            for other in self.right:
                rest = rest - other * (other @ rest)
        beta = float(np.linalg.norm(rest))
        self.size = max(self.size, beta)
        if beta <= self.settings.rounding * self.size or beta == 0.0:
            self.beta.append(0.0)
            self.right.append(self._fresh())
        else:
            self.beta.append(beta)
            self.right.append(self._orthogonal(rest / beta))

    def _freed(self, w: np.ndarray, z: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """u = Xw and Xᵀu without their parts along earlier left vectors."""
        for c, other, its in zip(along, self.left, self.back, strict=True):
            w, z = w - c * other, z - c * its
        return w, z

    def _product(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Xᵀu of u = Xw, its products with the earlier left vectors and with itself."""
        basis = np.array([*self.left, w]).T

        def of(x):
            y = x @ basis
            return np.concatenate([x.T @ y[:, -1], y.T @ y[:, -1]])

        found = self.product(of, self.dims + basis.shape[1])
        return found[: self.dims], found[self.dims : -1], found[-1]

    def solved(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Deviations, falling; right vectors as rows; residuals of the pairs."""
        k = len(self.alpha)
        small = np.diag(self.alpha) + np.diag(self.beta[: k - 1], 1)
        p, sigma, q = np.linalg.svd(small)
        return sigma, q @ np.array(self.right[:k]), np.abs(self.beta[k - 1] * p[-1])


def fit(vectors: DataFrame, settings: Settings = Settings()) -> Whitening:
    """Components of the distinct vectors in ``x`` (as ``whole_vectors`` gives them)."""
    distinct, _ = written(vectors.select("x").distinct(), "whitening-fit")
    n, dims = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    entries = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    sums = [0] * dims
    for i, s in entries.agg(F.sum(F.col("v").cast("decimal(38,0)"))).collect():
        sums[i] = int(s)
    none = Whitening(n, tuple(sums), np.zeros((0, dims)), np.zeros(0), 0.0, 0.0)
    if not n or not dims:
        return none
    mean = np.array([s / n for s in sums])

    def product(of, size):
        return _summed(distinct, dims, lambda rows: of(rows - mean), size)

    total = float(product(lambda x: np.array([(x * x).sum()]), 1)[0])
    if total == 0.0:
        return none
    wanted = min(settings.components, dims)
    state = _Bidiagonal(product, dims, settings)
    while True:
        state.step()
        sigma, right, residual = state.solved()
        if len(state.alpha) == dims:
            break
        if len(sigma) >= wanted:
            left = total - float((sigma**2).sum())
            enough = left < sigma[wanted - 1] ** 2 * (1 - 1e-9) or left <= total * 1e-14
            if enough and residual[:wanted].max() <= settings.rounding * sigma[0]:
                break
    real = sigma[:wanted] ** 2 > total * 1e-14
    directions, values = right[:wanted][real], sigma[:wanted][real] ** 2 / n
    directions = directions / np.linalg.norm(directions, axis=1, keepdims=True)
    scaled = (directions / np.sqrt(values)[:, None]).T
    k = len(values)

    def squares(x):
        y = x @ scaled
        return (y.T @ y).ravel()

    covariance = product(squares, k * k).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, tuple(sums), directions, values, total / n, error)


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """A row per vector and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dims, k = len(model.sums), len(model.eigenvalues)
    mean = np.array([s / model.n for s in model.sums]) if model.n else np.zeros(dims)
    scaled = (model.directions / np.sqrt(model.eigenvalues)[:, None]).T

    def rows_of(batches):
        for part, rows in _matrices(batches, dims):
            y = (rows - mean) @ scaled
            deviation = _deviations(rows, model)
            ids = column_of(part, "vec_id").cast(pa.int64())
            columns = [
                ids.take(pa.array(np.repeat(np.arange(len(rows)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * k, model.n, np.int64)),
                pa.array(np.repeat(deviation, k)),
                pa.array(y.ravel()),
                pa.array(np.tile(model.eigenvalues / model.trace, len(rows))),
                pa.array(np.full(len(rows) * k, model.identity_error)),
            ]
            names = [name.split()[0] for name in schema.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    return vectors.select("vec_id", "x").mapInArrow(rows_of, schema)


def _deviations(rows: np.ndarray, model: Whitening) -> np.ndarray:
    """Sum over dimensions of (n * x - S)^2, exact."""
    sums = [int(s) for s in model.sums]
    reach = max(abs(int(rows.min())), abs(int(rows.max()))) * model.n + max(abs(s) for s in sums)
    if len(sums) * reach * reach < 1 << 63:
        off = model.n * rows - np.array(sums, np.int64)
        return (off * off).sum(axis=1)
    exact = [sum((model.n * int(x) - s) ** 2 for x, s in zip(row, sums)) for row in rows]
    if max(exact) >= 1 << 63:
        raise OverflowError("deviation does not fit a long")
    return np.array(exact, np.int64)
