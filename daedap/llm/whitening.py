"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The eigenvectors of the covariance are found without the covariance: what is needed of it
are products with a few columns, each a pass over all vectors (centred X'XQ, added up by
the tasks). A polynomial recurrence of such passes damps the unwanted part of the spectrum;
QR and a Rayleigh-Ritz step on the filtered columns follow, until the residual of every
wanted pair certifies it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daedap.session import materialize

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16

# Columns that are carried along beyond the wanted ones.
SPARE = 16
DEGREE = 10
MOST_ROUNDS = 60

# Residual of a certified pair, as a share of the largest eigenvalue, and the part of the
# total variance below which a component counts as none.
TOLERANCE = 1e-12
NO_VARIANCE = 1e-12

BLOCK_ROWS = 4096

# Tasks whose sums come to the driver as they are; more are added up by tasks first.
FEW_SUMS = 64

VECTORS = "vec_id long, x binary"
BLOCKS = "n long, x binary"
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


def _finite(vector: str) -> F.Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def whole_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is whole and finite, x as little-endian longs.

    Raises where an entry times ``SCALE`` is beyond a long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            entries = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.floor(SCALE * entries)
            if len(x) and np.abs(x).max() >= 2.0**62:
                raise OverflowError("an embedding's entry is too large for a long")
            data = (x.astype("<i8") + SHIFT).tobytes()
            ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))])
            parts = [data[8 * a : 8 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["vec_id", "x"])

    vector = F.col("embedding").cast("array<double>").alias("embedding")
    kept = rows.select(F.col("vec_id").cast("long"), vector).filter(_finite("embedding"))
    return kept.mapInArrow(run, VECTORS)


def _matrix(cells: pa.Array) -> np.ndarray:
    """Binary cells of equal length as rows of longs."""
    parts = cells.to_pylist()
    width = len(parts[0]) if parts else 0
    if any(len(p) != width for p in parts):
        raise ValueError("embeddings have different lengths")
    return np.frombuffer(b"".join(parts), "<i8").reshape(len(parts), width // 8)


def distinct_blocks(vectors: DataFrame) -> DataFrame:
    """Each vector once, ``BLOCK_ROWS`` to a row; copies meet before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                parts = batch.column(0).slice(i, BLOCK_ROWS).to_pylist()
                whole = b"".join(parts)
                yield pa.RecordBatch.from_pydict(
                    {"n": pa.array([len(parts)], pa.int64()), "x": pa.array([whole], pa.binary())}
                )

    return vectors.select("x").distinct().mapInArrow(run, BLOCKS)


@dataclass(frozen=True)
class FitList:
    """The distinct vectors in blocks, how many they are, and their sums by dimension."""

    blocks: DataFrame
    n: int
    sums: list[int]
    tasks: int

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        """Exact to the last bit of a double."""
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def total(self, value: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all blocks of ``value(block)``, an array of doubles of this shape.

        Each task adds up its own blocks. Where there are many tasks, others add up their
        sums before any comes to the driver.
        """
        dimensions = self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, some = np.zeros(shape), False
            for batch in batches:
                for data in batch.column(1).to_pylist():
                    total += value(np.frombuffer(data, "<i8").reshape(-1, dimensions))
                    some = True
            if some:
                yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, some = np.zeros(shape), False
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    total += np.frombuffer(data).reshape(shape)
                    some = True
            if some:
                yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

        sums = self.blocks.mapInArrow(run, "total binary")
        if self.tasks > FEW_SUMS:
            sums = sums.repartition(math.isqrt(self.tasks)).mapInArrow(again, "total binary")
        parts = sorted(bytes(row["total"]) for row in sums.collect())
        return sum((np.frombuffer(p).reshape(shape) for p in parts), np.zeros(shape))


def fit_list(vectors: DataFrame) -> FitList | None:
    """None without any vector, or without dimensions."""
    blocks = materialize(distinct_blocks(vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, width, sums = 0, None, []
        for batch in batches:
            for rows, data in zip(*(c.to_pylist() for c in batch.columns)):
                if width not in (None, len(data) // rows) or len(data) % (8 * rows):
                    raise ValueError("embeddings have different lengths")
                width = len(data) // rows
                x = np.frombuffer(data, "<i8").reshape(rows, width // 8)
                # In halves, so that no sum of a block leaves a long.
                high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
                part = [(h << 32) + v for h, v in zip(high, low)]
                n, sums = n + rows, part if not sums else [a + b for a, b in zip(sums, part)]
        if n:
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array([n]), "sums": pa.array([[str(s) for s in sums]], pa.list_(pa.string()))}
            )

    # One row per task, then one per dimension.
    parts = materialize(blocks.mapInArrow(run, "n long, sums array<string>"))
    widths = [r["w"] for r in parts.select(F.size("sums").alias("w")).distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError("embeddings have different lengths")
    if not widths or widths[0] == 0:
        return None
    n = parts.agg(F.sum("n")).first()[0]
    by_dimension = (
        parts.select(F.posexplode("sums").alias("i", "s"))
        .groupBy("i")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        .orderBy("i")
    )
    sums = [int(r["s"]) for r in by_dimension.collect()]
    return FitList(blocks, n, sums, blocks.rdd.getNumPartitions())


@dataclass(frozen=True)
class Whitening:
    """Eigenvectors as columns, their eigenvalues, and the share of the variance of each."""

    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    residual: float  # the largest, as a share of the largest eigenvalue
    passes: int


def filtered(
    product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, cut: float, top: float, degree: int
) -> np.ndarray:
    """``q`` under a Chebyshev polynomial of the covariance that is small on [low, cut].

    Scaled by its value at ``top`` step by step, so that nothing overflows.
    """
    centre, half = (cut + low) / 2, max((cut - low) / 2, top * 1e-15)
    sigma = first = half / (centre - top) if centre != top else 1.0
    before, now = q, (product(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (product(now) - centre * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def principal_components(
    product: Callable[[np.ndarray], np.ndarray],
    dimensions: int,
    trace: float,
    wanted: int = COMPONENTS,
    spare: int = SPARE,
    degree: int = DEGREE,
    tolerance: float = TOLERANCE,
    most_rounds: int = MOST_ROUNDS,
) -> Whitening:
    """The ``wanted`` largest eigenpairs of the covariance that ``product`` multiplies with.

    Ends when all of them are certified: the residual |Vq - eq| is below ``tolerance`` times
    the largest eigenvalue, or has not fallen for three rounds, at the limit of doubles;
    raises ArithmeticError if that limit is not small. Components with next to no variance
    are left out.
    """
    size = min(dimensions, wanted + spare)
    wanted = min(wanted, dimensions)
    passes = 0

    def counted(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(q)

    start = np.random.default_rng(20_250_101).normal(size=(dimensions, size))
    q, _ = np.linalg.qr(start)
    best, stalled = math.inf, 0
    found: tuple[np.ndarray, np.ndarray] = q[:, :wanted], np.zeros(wanted)
    for _ in range(most_rounds):
        vq = counted(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        if top <= 0:
            return Whitening(q[:, :0], values[:0], values[:0], 0.0, passes)
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / top
        if residual < best:
            found = q[:, :wanted].copy(), values[:wanted].copy()
        stalled = 0 if residual < 0.5 * best else stalled + 1
        best = min(best, residual)
        if best <= tolerance or stalled >= 3 or size == dimensions:
            break
        q, _ = np.linalg.qr(filtered(counted, q, 0.0, max(values[-1], 0.0), top, degree))
    if best > math.sqrt(tolerance):
        raise ArithmeticError(f"components are not certified: residual {best:.1e}")
    vectors, values = found
    kept = values > NO_VARIANCE * trace
    return Whitening(vectors[:, kept], values[kept], values[kept] / trace, best, passes)


def fitted(vectors: FitList, components: int = COMPONENTS) -> Whitening:
    mean, n, d = vectors.mean, vectors.n, vectors.dimensions

    def product(q: np.ndarray) -> np.ndarray:
        def value(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return vectors.total(value, q.shape) / n

    trace = float(vectors.total(lambda x: ((x - mean) ** 2).sum(0), (d,)).sum()) / n
    return principal_components(product, d, trace, components)


def identity_error(vectors: FitList, found: Whitening) -> float:
    """The largest entry by which the whitened vectors' covariance is not the identity."""
    mean, turn = vectors.mean, found.vectors / np.sqrt(found.values)

    def value(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ turn
        return np.vstack([y.T @ y, y.sum(0)])

    k = len(found.values)
    total = vectors.total(value, (k + 1, k)) / vectors.n
    covariance = total[:k] - np.outer(total[k], total[k])
    return float(np.abs(covariance - np.eye(k)).max()) if k else 0.0


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every
    ``rows(vec_id, embedding)`` whose vector is whole and finite, a row per component.

    Null vectors and such with null or non-finite entries are dropped. Null and repeated ids
    are kept, each row by its own vector; copies of a vector count once in the fit; other
    columns play no part. Vectors of different lengths raise an error, as does a deviation
    beyond a long. There are fewer components where there are fewer dimensions or no more
    variance, so none for an empty table or a single vector. Vectors and the fit list are
    written once to the shared folder.
    """
    vectors = materialize(whole_vectors(rows))
    fit = fit_list(vectors)
    if fit is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    found = fitted(fit, components)
    error = identity_error(fit, found)
    n, d, k = fit.n, fit.dimensions, len(found.values)
    mean, sums = fit.mean, np.array(fit.sums, object)
    turn, explained = found.vectors / np.sqrt(found.values), found.explained
    # n * x - S is (x - base) * n - (S - base * n): small numbers where S itself is large.
    base = np.array([s // n for s in fit.sums], np.int64)
    rest = (sums - base.astype(object) * n).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RESULT.split(", ")]
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(i, BLOCK_ROWS)
                x = _matrix(batch.column(1))
                if x.shape[1] != d:
                    raise ValueError("embeddings have different lengths")
                if float((((x - mean) * n) ** 2).sum(1).max(initial=0)) >= 2.0**63 * (1 - 1e-9):
                    raise OverflowError("a deviation is too large for a long")
                deviation = (((x - base) * n - rest) ** 2).sum(1)
                y = (x - mean) @ turn
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, n)),
                        pa.array(np.repeat(deviation, k)),
                        pa.array(y.reshape(-1)),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(x) * k, error)),
                    ],
                    names=names,
                )

    return vectors.mapInArrow(run, RESULT)
