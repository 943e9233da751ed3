"""Embedding whitening: principal components of all distinct vectors, and every vector's whitened coordinates.

Entries become integers, x = floor(64 c) + 1,000,000, so sums and products over the table are exact
whatever the order of tasks. Each task multiplies its own vectors, centred by a whole number next to the
mean, and sends d * (d + 1) / 2 sums; what the rounding of the mean left over is taken off exactly. The
driver holds matrices of d * d numbers and nothing that grows with the rows.

The eigenvectors are found in mixed precision: a float32 solver gives a first basis, and iterations after
Ogita and Aishima correct it with matrix products in extended precision (`np.longdouble`), doubling the
right digits each time. The correction divides by differences of eigenvalues; where these are too close to
be told apart, the columns of such a cluster are turned by a small eigenproblem of their own, in double
precision and shifted by the cluster's mean, and the iteration goes on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bantin.llm.common import query, stored, table

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
_EXACT = 2.0**53
_WIDE = np.longdouble
# Eigenvalues below this share of the trace are zero: no vector differs along them.
_NOTHING = 1e-15


# --- the eigenproblem, on the driver ----------------------------------------------------


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One correction of the basis x: the new basis, its eigenvalues, the largest correction, the unsafe gap."""
    rest = np.eye(len(a), dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # or its rounding would tilt columns whose eigenvalues are near each other
    values = np.diagonal(s) / (1 - np.diagonal(rest))
    off = s - np.diag(values)
    gap = float(2 * (np.linalg.norm(off.astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(rest.astype(float))))
    apart = values[None, :] - values[:, None]
    close = np.abs(apart) <= gap
    e = np.where(close, rest / 2, (s + values[None, :] * rest) / np.where(close, 1, apart))
    return x + x @ e, values, float(np.abs(e).max()), gap


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within the gap, two or more at a time."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def eigenvectors(matrix: np.ndarray, most_rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision.

    Equal eigenvalues have some orthonormal basis of their space.
    """
    size = np.abs(matrix).max() if matrix.size else _WIDE(0)
    if not size:
        return np.zeros(len(matrix), _WIDE), np.eye(len(matrix), dtype=_WIDE)
    a = matrix.astype(_WIDE) / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_WIDE)
    for _ in range(most_rounds):
        x, values, change, gap = _step(a, x)
        groups = _clusters(values, gap)
        for group in groups:
            part = x[:, group]
            inner = part.T @ (a @ part - values[group].mean() * part)
            largest = np.abs(inner).max()
            if largest:
                inner = ((inner + inner.T) / (2 * largest)).astype(float)
                x[:, group] = part @ np.linalg.eigh(inner)[1].astype(_WIDE)
        # Corrections square in each round: after one this small, the rest is rounding.
        if change < 1e-12 and gap < 1e-15:
            break
    x, values, _, _ = _step(a, x)
    x = x + x @ (np.eye(len(a), dtype=_WIDE) - x.T @ x) / 2
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(x))])
    return values[order] * size, x * sign


# --- exact sums over the rows -----------------------------------------------------------


def _block(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, one a row."""
    flat = batch["x"].flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(batch), -1)


def _exact_products(z: np.ndarray) -> np.ndarray:
    """z' z as Python integers."""
    most = max(1, int(np.abs(z).max()))
    rows = int(_EXACT // (most * most))
    if rows < 1:
        wide = z.astype(object)
        return wide.T @ wide
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for at in range(0, len(z), rows):
        part = z[at : at + rows].astype(float)  # every partial sum is below 2^53, so this is exact
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors, and the sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (d + 1)
        for batch in batches:
            for at in range(0, len(batch), 1 << 20):
                block = _block(batch.slice(at, 1 << 20))
                totals = [a + b for a, b in zip(totals, [len(block), *map(int, block.sum(axis=0))])]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(totals, pa.decimal128(38, 0))], ["i", "v"])

    found = {r.i: int(r.v) for r in fit.mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return found.get(0, 0), [found.get(i, 0) for i in range(1, d + 1)]


def _products(fit: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Sums of products of all vectors less `centre`, as Python integers."""
    d = len(centre)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            if len(batch):
                total = total + _exact_products(_block(batch) - centre)
        values = pa.array([int(v) for v in total[upper]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), values], ["i", "j", "v"])

    out = np.zeros((d, d), object)
    for r in fit.mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = int(r.v)
    return out


def covariance(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S, and the covariance (divisor n) of the vectors, right to extended precision."""
    n, sums = _sums(fit, d)
    centre = [s // n for s in sums]
    products = _products(fit, np.array(centre, np.int64))
    left = [s - n * m for s, m in zip(sums, centre)]
    out = np.zeros((d, d), _WIDE)
    for i in range(d):
        for j in range(i, d):
            exact = Fraction(n * products[i, j] - left[i] * left[j], n * n)
            high = float(exact)
            out[i, j] = out[j, i] = _WIDE(high) + _WIDE(float(exact - Fraction(high)))
    return n, sums, out


class Whitening:
    """Means and scaled components; small, whatever the table: workers receive it as it is."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float) -> None:
        self.n, self.sums = n, np.array(sums, np.int64)
        self.explained = (values / trace).astype(float)
        self.scaled = (vectors / np.sqrt(values)).astype(float)

    def whitened(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - S, exact, and the whitened coordinates."""
        centred = self.n * x - self.sums
        return centred, (centred / self.n) @ self.scaled


def _squares(centred: np.ndarray) -> list[int]:
    """Sums of squares, exact."""
    most = int(np.abs(centred).max(initial=0))
    if most * most * max(1, centred.shape[1]) < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    return [sum(v * v for v in row) for row in centred.tolist()]


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit vectors, less the identity."""
    k = model.scaled.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if len(batch):
                w = model.whitened(_block(batch))[1]
                total += np.concatenate([w.sum(axis=0)[None], w.T @ w])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((k + 1, k))
    for r in fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = r.v
    mean = total[0] / model.n  # the whitened vectors are centred already: this is rounding
    return float(np.abs(total[1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component: its whitened coordinate, and measures of the whole fit.

    A row takes no part if its vector is null or holds null or non-finite entries, or if its length is not
    that of most rows (of equally many, the longer). Repeated rows are answered each on its own, but the
    components are fitted on each distinct vector once. Components without variance are left out, so
    that no vectors, one vector or only equal ones give no rows, and d entries give at most d components.
    A null `key` stays null. `n` times an entry must stay below 2^63. Other columns are not looked at.
    """
    c = F.col(vector)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + SHIFT)
    kept = rows.where(c.isNotNull() & finite).select(F.col(key).cast("long").alias("vec_id"), x.alias("x"))
    spark = rows.sparkSession
    width = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], SCHEMA)
    if width is None or not width.d:
        return empty
    d = width.d
    kept = kept.where(F.size("x") == d)
    fit = stored(kept.select("x").distinct())
    n, sums, matrix = covariance(fit, d)
    trace = matrix.trace()
    values, vectors = eigenvectors(matrix)
    used = int((values[:components] > _NOTHING * trace).sum())
    if not used:
        return empty
    model = Whitening(n, sums, values[:used], vectors[:, :used], trace)
    error = _identity_error(fit, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 2_000) for at in range(0, len(whole), 2_000)):
                centred, w = model.whitened(_block(batch))
                m = len(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"].take(pa.array(np.repeat(np.arange(m), used))),
                        pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * used, n, np.int64)),
                        pa.array(_squares(centred), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), used))),
                        pa.array(w.ravel()),
                        pa.array(np.tile(model.explained, m)),
                        pa.array(np.full(m * used, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return kept.mapInArrow(run, SCHEMA)


@query()
def op12_embedding_whitening(spark, sf_dir):
    """Every vector's coordinates along the first 16 components."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
