"""Embedding whitening by incremental eigendecomposition.

Every task keeps a spectrum of the rows it has read: their number, their exact sums, and the eigenvalues and
eigenvectors of their centred scatter. New rows enter by rank-one updates: the new eigenvalues are the roots of the
secular equation, found between the old ones for all roots at once; directions that a row doesn't touch, and those of
equal eigenvalues (after a rotation), are deflated, that is, kept as they are; eigenvectors come from the roots by
Loewner's formula, which keeps them orthogonal. A block of more rows than dimensions is first turned (QR) into as many
rows as there are dimensions with the same scatter, so that a row costs little however many there are. One more rank-one
update, along the difference of the two means, joins a block to the spectrum. Spectra of tasks are stored and combined
in groups of ``MERGED_AT_ONCE``, level by level, by the same updates. The last step is a Rayleigh-Ritz refinement: one
pass over all rows sums their products in the found basis, and the small eigenproblem that is left corrects it.

All rows with a usable vector are fitted and returned. An entry c, as double, stands as the whole number
``floor(1024 * c) + 100000``. Not usable, and left out: null vectors, vectors with null, NaN or infinite entries or
entries of 2**40 or more, empty ones, and those whose length isn't the commonest (the longest of equally common ones).
Rows that repeat, or share their key, count and are returned as often as they occur; null keys stay null. Fewer
dimensions than components give fewer components. A component without variance (an eigenvalue within rounding of 0; all
of them for a single row) has ``whitened`` NULL and isn't part of ``identity_error``; without any variance
``explained`` is NULL too. ``deviation`` is NULL where it is beyond a long. An empty table gives no rows. Only the key
is carried over; a key named like a result column is returned as ``key``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
BLOCK_ROWS = 4096
MERGED_AT_ONCE = 16
BISECTIONS = 66
_EPS = np.finfo(float).eps
_SPECTRUM = "part long, n long, sums array<long>, values array<double>, vectors array<double>"
RESULTS = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def _secular_roots(poles: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """For 1 + rho * sum(z**2 / (poles - x)) = 0 with rising poles: ``near - x`` as a matrix [root, pole], and the roots.

    Each root is sought from the nearer of the two poles around it, and by the logarithm of its distance from that pole,
    so that the smallest distances keep their digits too.
    """
    k = len(poles)
    right = np.append(poles[1:], poles[-1] + rho * (z @ z))
    half = (right - poles) / 2
    weights = rho * z * z
    at_middle = 1 + (weights / (poles - (poles + half)[:, None])).sum(1)
    from_left = at_middle >= 0
    beyond = not from_left[-1]  # the last root has no pole at its right
    from_left[-1] = True
    sign = np.where(from_left, 1.0, -1.0)
    near = np.arange(k) + ~from_left
    offsets = poles - poles[near][:, None]
    apart = np.abs(offsets)
    apart[np.arange(k), near] = np.inf
    least = weights[near] / (1 + 2 * (weights / apart).sum(1))
    if beyond:
        least[-1], half[-1] = half[-1], 2 * half[-1]
    high = np.log(half)
    low = np.minimum(np.log(least), high)
    for _ in range(BISECTIONS):
        guess = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            above = 1 + (weights / (offsets - (sign * np.exp(guess))[:, None])).sum(1) > 0
        nearer = above == from_left
        low, high = np.where(nearer, low, guess), np.where(nearer, guess, high)
    step = sign * np.exp((low + high) / 2)
    return offsets - step[:, None], poles[near] + step


def rank_one(values: np.ndarray, vectors: np.ndarray, direction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) after adding ``direction direction^T``."""
    z = vectors.T @ direction
    rho = float(z @ z)
    if rho == 0.0 or not np.isfinite(rho):
        return values, vectors
    z = z / np.sqrt(rho)
    tolerance = 8 * _EPS * max(float(np.abs(values).max()), rho)
    active = np.flatnonzero(rho * np.abs(z) > tolerance)
    vectors = vectors.copy()
    kept: list[int] = []
    for at in active:  # of two equal eigenvalues one is turned out of the way
        if kept:
            before = kept[-1]
            length = np.hypot(z[before], z[at])
            c, s = z[at] / length, z[before] / length
            if abs((values[at] - values[before]) * c * s) <= tolerance:
                z[at], z[before] = length, 0.0
                first, second = vectors[:, before].copy(), vectors[:, at].copy()
                vectors[:, before], vectors[:, at] = c * first - s * second, s * first + c * second
                low, high = values[before], values[at]
                values = values.copy()
                values[before], values[at] = low * c * c + high * s * s, low * s * s + high * c * c
                kept.pop()
        kept.append(int(at))
    if not kept:
        return values, vectors
    index = np.array(kept)
    index = index[np.argsort(values[index], kind="stable")]
    poles, weight = values[index], z[index]
    if (np.diff(poles) <= 0).any():  # rounding of a turn may have closed a gap
        poles = np.maximum.accumulate(poles) + np.arange(len(poles)) * np.spacing(max(abs(poles[-1]), 1e-300))
    gaps, roots = _secular_roots(poles, weight, rho)
    k = len(poles)
    apart = poles[:, None] - poles[None, :]  # [i, j]: pole i - pole j
    lower = np.tri(k, k, -1, bool).T  # i < j
    with np.errstate(divide="ignore", invalid="ignore"):  # root i - pole j over a pole's distance from pole j
        factors = np.where(lower, -gaps / apart, -gaps / np.roll(apart, -1, axis=0))
    factors[-1] = -gaps[-1]
    loewner = np.sqrt(np.abs(np.prod(factors, axis=0) / rho))
    turned = np.copysign(loewner, weight)[None, :] / gaps
    turned /= np.linalg.norm(turned, axis=1)[:, None]
    values, result = values.copy(), vectors
    values[index] = roots
    result[:, index] = vectors[:, index] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], result[:, order]


@dataclass
class Spectrum:
    """``n`` rows with exact ``sums``; their centred scatter is vectors @ diag(values) @ vectors.T."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def none(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def _add(self, n: int, sums: np.ndarray, directions: np.ndarray) -> None:
        """Add rows given by their number, sums, and directions whose products make up their centred scatter."""
        if not n:
            return
        if self.n:
            apart = sums / n - self.sums / self.n
            directions = np.vstack([directions, apart * np.sqrt(self.n / (self.n + n) * n)])
        for direction in directions:
            self.values, self.vectors = rank_one(self.values, self.vectors, direction)
        self.n, self.sums = self.n + n, self.sums + sums

    def add_rows(self, x: np.ndarray) -> None:
        sums = x.sum(0)
        centred = x - sums / len(x)
        self._add(len(x), sums, centred if len(x) <= x.shape[1] else np.linalg.qr(centred, mode="r"))

    def add(self, other: Spectrum) -> None:
        used = other.values > 0
        self._add(other.n, other.sums, (other.vectors[:, used] * np.sqrt(other.values[used])).T)

    def batch(self, part: int) -> pa.RecordBatch:
        lists = [pa.array([self.sums.tolist()], pa.list_(pa.int64()))]
        lists += [pa.array([a.ravel().tolist()], pa.list_(pa.float64())) for a in (self.values, self.vectors)]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([self.n], pa.int64()), *lists], ["part", "n", "sums", "values", "vectors"])

    @staticmethod
    def read(row: dict) -> Spectrum:
        size = len(row["values"])
        return Spectrum(row["n"], np.array(row["sums"], np.int64), np.array(row["values"]), np.array(row["vectors"]).reshape(size, size))


def whole_numbers(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The column ``vector`` of a batch as whole numbers, one row per vector."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(-1, size)).astype(np.int64) + SHIFT


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def spectrum(rows: DataFrame, size: int) -> Spectrum:
    """The spectrum of all rows (column ``vector``, each of ``size`` doubles): per task first, then level by level."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, n = Spectrum.none(size), [], 0
        for batch in batches:
            held.append(whole_numbers(batch, size))
            n += len(held[-1])
            if n >= BLOCK_ROWS:
                own.add_rows(np.concatenate(held))
                held, n = [], 0
        if n:
            own.add_rows(np.concatenate(held))
        if own.n:
            yield own.batch(TaskContext.get().partitionId())

    def merged(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda row: row["part"])
        own = Spectrum.none(size)
        for row in found:
            own.add(Spectrum.read(row))
        return pa.Table.from_batches([own.batch(found[0]["part"] // MERGED_AT_ONCE)])

    spark = rows.sparkSession
    parts = stored(spark, rows.select("vector").mapInArrow(per_task, _SPECTRUM), "spectra")
    while parts.count() > 1:
        group = F.floor(F.col("part") / MERGED_AT_ONCE).cast("long")
        parts = stored(spark, parts.groupBy(group).applyInArrow(merged, _SPECTRUM), "spectra")
    return Spectrum.read(parts.first().asDict())


def _products(rows: DataFrame, size: int, basis: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance of all rows in the given basis (divisor n): partial sums per task, added up per entry."""
    width = basis.shape[1]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            seen = (whole_numbers(batch, size) - sums / n) @ basis
            total += seen.T @ seen
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["at", "total"])

    summed = rows.select("vector").mapInArrow(per_task, "at long, total double").groupBy("at").agg(F.sum("total").alias("total"))
    # Bounded by the square of the number of dimensions.
    total = np.zeros(width * width)
    for at, value in summed.collect():
        total[at] = value
    return total.reshape(width, width) / n


def whiten(df: DataFrame, key: str, vector: str, components: int = 8) -> DataFrame:
    """One row per usable row of ``df`` and component, components from 1 by falling eigenvalue.

    ``key`` (see above for its name), ``component`` int, ``n`` long, ``deviation`` long (sum over dimensions of
    (n*x - S)**2, exact), ``whitened`` double (centred x on the component over the root of its eigenvalue),
    ``explained`` double (eigenvalue over trace), ``identity_error`` double (largest absolute entry of the whitened
    rows' covariance minus the identity, measured over all rows).
    """
    name = "key" if key in RESULTS else key
    doubles = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).alias(name), doubles.alias("vector")).filter(usable(F.col("vector")))
    fields = [rows.schema[name], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType())]
    schema = T.StructType([*fields, *(T.StructField(c, T.DoubleType()) for c in RESULTS[3:])])
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return df.sparkSession.createDataFrame([], schema)
    size = sizes["size"]
    rows = rows.filter(F.size("vector") == size)

    found = spectrum(rows, size)
    n, sums = found.n, found.sums
    small = _products(rows, size, found.vectors, n, sums)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    trace, largest = float(np.trace(small)), float(max(values.max(), 0.0))
    values, basis = values[order], found.vectors @ turn[:, order]
    real = values > max(largest * size * _EPS * 16, 0.0)
    scaled = basis / np.sqrt(np.where(real, values, 1.0))
    error = None
    if real.any():
        error = float(np.abs(_products(rows, size, scaled[:, real], n, sums) - np.eye(int(real.sum()))).max())
    shares = [float(e) / trace if trace > 0 else None for e in np.maximum(values, 0.0)]
    k = len(order)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch, size)
            rows_in = len(x)
            seen = (x - sums / n) @ scaled
            # Whole numbers without bound where a long might not hold them.
            wide = float(np.abs(x - sums / n).max(initial=0.0)) * n
            far = (n * x - sums) if wide * wide * size < 2**62 else (n * x.astype(object) - sums.astype(object))
            deviation = [int(v) if abs(int(v)) < 2**63 else None for v in (far * far).sum(1)]
            picked = np.repeat(np.arange(rows_in), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(name).take(pa.array(picked)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_in)),
                    pa.array(np.full(rows_in * k, n, np.int64)),
                    pa.array([deviation[i] for i in picked], pa.int64()),
                    pa.array(seen.ravel(), mask=np.tile(~real, rows_in)),
                    pa.array(shares * rows_in, pa.float64()),
                    pa.array([error] * (rows_in * k), pa.float64()),
                ],
                schema.names,
            )

    return rows.mapInArrow(per_task, schema)
