"""Embedding whitening by shifted CholeskyQR.

Rows are centred and orthogonalised by distributed Gram passes: a pass sums Q'Q of Q = A inv(R), solved against the
triangular R in tasks, and its Cholesky factor is composed with R. The first factor is of the Gram matrix plus a shift, so
that it exists for ill-conditioned rows; later ones repair what the shift left. The singular values and right vectors of
the composed R are those of A, and give the whitening components. Each pass reads the rows anew: nothing of Q is stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import LARGEST, SCALE, blocks, kept

#: Added to scaled entries.
OFFSET = 100_000
COMPONENTS = 8
PASSES = 8
UNIT = 2.0**-53


@dataclass(frozen=True)
class Whitening:
    """n rows with exact sums per dimension; components (dims, k) with their eigenvalues, by falling eigenvalue.

    A component whose eigenvalue is not told from 0 has eigenvalue 0: nothing can be divided by its deviation.
    """

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    #: The most that an entry of n * x - S can be.
    spread: int

    @property
    def dims(self) -> int:
        return len(self.sums)

    def from_mean(self, scaled: np.ndarray) -> np.ndarray:
        """n * x - S in exact integers, of 64 bits where those hold its parts and the sum of its squares."""
        if max(self.dims * self.spread**2, 2 * self.n * (LARGEST * SCALE + OFFSET)) >= 1 << 63:
            return (scaled.astype(object) + OFFSET) * self.n - np.array(self.sums, object)
        return (scaled + OFFSET) * self.n - np.array(self.sums, np.int64)

    def centred(self, scaled: np.ndarray) -> np.ndarray:
        return (self.from_mean(scaled) / self.n).astype(np.float64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Projections in standard deviations; NaN where the eigenvalue is 0."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, centred @ self.vectors / np.sqrt(self.values), np.nan)


def _solve(upper: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """rows @ inv(upper), column after column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _totals(rows: DataFrame, vector: str, dims: int) -> tuple[int, tuple[int, ...], int]:
    """Number of rows, sums of x per dimension and the most that n * x - S can be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, low, high = 0, np.zeros(dims, np.int64), np.full(dims, 1 << 62), np.full(dims, -(1 << 62))
        for _, x in blocks(batches, vector, dims):
            x = x + OFFSET
            n, sums, low, high = n + len(x), sums + x.sum(0), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(sums), pa.array(low), pa.array(high)], names=["i", "n", "s", "low", "high"])

    parts = rows.select(vector).mapInArrow(run, "i long, n long, s long, low long, high long")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    found = sorted(found, key=lambda r: r.i)  # one row a dimension
    n = found[0].n
    return n, tuple(int(r.s) for r in found), max(n * (r.high - r.low) for r in found)


def _gram(rows: DataFrame, vector: str, width: int, dims: int, of) -> tuple[np.ndarray, np.ndarray]:
    """Sums of q and of q'q over all rows' q = of(scaled). A task hands on one matrix; entries are summed by place."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, some = np.zeros((width, width)), np.zeros(width), False
        for _, x in blocks(batches, vector, dims):
            q = of(x)
            total, mean, some = total + q.T @ q, mean + q.sum(0), True
        if some:
            at = [np.concatenate((i, np.full(width, -1))), np.concatenate((j, np.arange(width))), np.concatenate((total[i, j], mean))]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in at], names=["i", "j", "g"])

    sums = rows.select(vector).mapInArrow(run, "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()
    gram, mean = np.zeros((width, width)), np.zeros(width)
    own = sums[sums.i >= 0]
    gram[own.i, own.j] = gram[own.j, own.i] = own.g
    own = sums[sums.i < 0]
    mean[own.j] = own.g
    return gram, mean


def factor(gram: np.ndarray, rows: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor of gram, with a shift in proportion to rounding where asked for or needed."""
    d = len(gram)
    shift = 11 * (rows * d + d * (d + 1)) * UNIT * np.linalg.norm(gram, 2)
    if not shifted:
        with suppress(np.linalg.LinAlgError):
            return np.linalg.cholesky(gram).T
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def fit(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """The rows that take part (see vectors.kept) and their whitening; None without any row."""
    rows, dims = kept(rows, vector)
    if not dims:
        return rows, None
    n, sums, spread = _totals(rows, vector, dims)
    plain = Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0, 0, spread)
    upper, passes = None, 0
    while passes < PASSES:
        passes += 1
        of = plain.centred if upper is None else (lambda x, r=upper: _solve(r, plain.centred(x)))
        gram, _ = _gram(rows, vector, dims, dims, of)
        if not gram.any():
            upper = np.zeros((dims, dims))
            break
        own = factor(gram, n, shifted=upper is None)
        near = np.linalg.eigvalsh(gram)
        upper = own if upper is None else own @ upper
        if ((np.abs(near - 1) < 1e-6) | (near < 1e-6)).all() and passes > 1:
            break
    _, singular, right = np.linalg.svd(upper)
    values = singular**2 / n
    values = np.where(singular > singular[0] * 1e-12, values, 0.0) if singular[0] else np.zeros(dims)
    k = min(components, dims)
    vectors = right[:k].T
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    return rows, Whitening(n, sums, vectors * sign, values[:k], float((singular**2).sum() / n), passes, spread)


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over components that have spread."""
    live = np.flatnonzero(model.values > 0)
    if not len(live):
        return 0.0
    gram, sums = _gram(rows, vector, len(live), model.dims, lambda x: model.whitened(model.centred(x))[:, live])
    mean = sums / model.n
    return float(np.abs(gram / model.n - np.outer(mean, mean) - np.eye(len(live))).max())


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each row that takes part and component.

    Rows whose vector is null, holds a null or non-finite entry, one of magnitude LARGEST, or has another dimension than
    most do not take part. Repeated or null vec_ids and equal vectors are rows of their own. Where all vectors are equal, or
    a component's eigenvalue is 0, whitened is null and explained 0. deviation is null where 64 bits can't hold it. An empty
    table gives no rows; columns besides vec_id and the vector aren't read.
    """
    rows, model = fit(rows.select("vec_id", vector), components, vector)
    schema = "vec_id long, component int, deviation long, whitened double, explained double"
    if model is None:
        none = rows.sparkSession.createDataFrame([], schema)
        return none.select("vec_id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(0.0).alias("identity_error"))
    k = len(model.values)
    explained = model.values / model.trace if model.trace else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in blocks(batches, vector, model.dims):
            apart = model.from_mean(x)
            deviation = (apart * apart).sum(1)
            if deviation.dtype == object:
                deviation = [v if v < 1 << 63 else None for v in deviation]
            out = model.whitened((apart / model.n).astype(np.float64))
            repeat = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").cast(pa.int64()).take(pa.array(repeat)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(deviation, pa.int64()).take(pa.array(repeat)),
                 pa.array(out.ravel(), from_pandas=True), pa.array(np.tile(explained, len(x)))],
                names=["vec_id", "component", "deviation", "whitened", "explained"],
            )

    off = identity_error(rows, model, vector)
    made = rows.mapInArrow(run, schema)
    return made.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(off).alias("identity_error"))
