"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without ever forming it.  A block Q of
vectors goes to the tasks, each adds up XᵀXQ over its centred rows, and the partial results,
of the size of Q, are added up by a second set of tasks.  Each such pass reads the rows once,
packed in blocks.  One round of the iteration:

1. filter: a Chebyshev polynomial of the covariance, by its three-term recurrence, one
   pass for each degree.  It stays within one on the unwanted part of the spectrum, between the
   lower edge and the least Ritz value of the block, and grows fast above it;
2. QR of the filtered block;
3. Rayleigh-Ritz: one pass, and the eigenvectors of a matrix as small as the block.

The lower edge comes from a few Lanczos passes with one vector; it changes the speed
only.  The pass of step 3 also certifies: rounds go on until |Vq - eq| of each wanted pair is
at most `tolerance` of the largest eigenvalue.  An eigenvalue lies that near to e.

The driver holds matrices of dimension by block, never rows.  Rows whose vector is null, or
holds null or non-finite entries, are left out; so are empty vectors and those of another
length than the commonest (of equally common ones, the longest).  Ids may repeat or be null,
each row counts.  Directions without variance get no component.  Without rows there is no
component and the result is empty.  Columns of the input other than id and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

ROWS = 4096  # of a block
GUARD = 16  # vectors beyond the wanted ones: they widen the gap to the rest
DEGREE = 10
LANCZOS = 12
ROUNDS = 60
EMPTY = 1e-12  # share of the largest eigenvalue below which a direction has no variance


@dataclass
class Whitening:
    """Components by falling eigenvalue, as columns, with what was measured on the way."""

    n: int
    mean: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residual: float  # largest |Vq - eq| as a share of the largest eigenvalue
    rounds: int
    passes: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues


def nothing() -> Whitening:
    """What there is to say without rows."""
    return Whitening(0, np.empty(0), np.empty((0, 0)), np.empty(0), 0.0, 0.0, 0, 0)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there, holds finite numbers only, and is as long as most."""
    v = F.col(f"`{vector}`")
    good = vectors.where(
        v.isNotNull()
        & (F.size(v) > 0)
        & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    )
    lengths = good.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    return good.where(F.size(v) == (most["d"] if most else 0))


class Passes:
    """Sums over all rows of a table of `usable` vectors; the rows are packed once.

    What a task adds up has a fixed size, and few such sums reach the driver.
    """

    def __init__(self, vectors: DataFrame, vector: str = "embedding"):
        column = vectors.select(F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double")).alias("v"))

        def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows:
                rows = _matrix(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows.tobytes()], pa.binary()), pa.array([rows.shape[1]], pa.int64())], names=["rows", "d"]
                )

        self.blocks = common.store(common.in_batches(column, pack, "rows binary, d long", rows=ROWS), "vector-blocks")
        self.tasks = self.blocks.rdd.getNumPartitions()
        self.count = 0

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
        """The sum of a function of the blocks, added up in two steps; None without rows."""
        self.count += 1

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from added(
                of(np.frombuffer(rows, np.float64).reshape(-1, d))
                for batch in batches
                for rows, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            )

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from added(
                np.frombuffer(b, np.float64) for batch in batches for b in batch.column(0).to_pylist()
            )

        def added(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            total = None
            for part in parts:
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        sums = self.blocks.mapInArrow(partial, "part binary")
        if self.tasks > 16:
            sums = sums.repartition(math.isqrt(self.tasks)).mapInArrow(merge, "part binary")
        found = [np.frombuffer(r[0], np.float64) for r in sums.collect()]
        return sum(found[1:], found[0]) if found else None


def fit(
    passes: Passes,
    k: int,
    tolerance: float = 1e-13,
    certified: float = 1e-9,
    seed: int = 1,
) -> Whitening | None:
    """The k leading components; None without rows.

    Rounds end once all residuals are at most `tolerance`, or no longer shrink, as sums of
    doubles end somewhere.  A residual over `certified` then raises an error.
    """
    first = passes.total(lambda x: np.concatenate(([len(x)], x.sum(0))))
    if first is None:
        return None
    n, mean = int(first[0]), first[1:] / first[0]
    d = len(mean)

    def centred(x: np.ndarray) -> np.ndarray:
        return x - mean

    # Sums of large numbers lose digits: what they lack is in the sum of the centred rows.
    mean = mean + passes.total(lambda x: centred(x).sum(0)) / n
    trace = float(passes.total(lambda x: np.array([np.square(centred(x)).sum()]))[0]) / n

    def times(q: np.ndarray) -> np.ndarray:
        """The covariance times a block, in one pass."""

        def part(x: np.ndarray) -> np.ndarray:
            x = centred(x)
            return (x.T @ (x @ q)).ravel()

        return passes.total(part).reshape(q.shape) / n

    if trace == 0:
        return Whitening(n, mean, np.empty((d, 0)), np.empty(0), trace, 0.0, 0, passes.count)
    rng = np.random.default_rng(seed)
    width = min(d, k + GUARD)
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    low = _lower_edge(times, rng.standard_normal(d)) if width < d else 0.0
    q, values, residual = _ritz(q, times(q), k)
    rounds = 0
    while residual > tolerance and width < d and rounds < ROUNDS:
        filtered = _filtered(times, q, low, max(values[-1], low + 1e-6 * values[0]), values[0])
        basis = np.linalg.qr(filtered)[0]
        q, values, now = _ritz(basis, times(basis), k)
        rounds += 1
        # At the limit of double sums rounds only move the last digits.
        done = now > residual / 2 and now < 1e-11
        residual = now
        if done:
            break
    if residual > certified:
        raise ArithmeticError(f"residual {residual:.1e} after {rounds} rounds")
    wanted = (np.arange(len(values)) < k) & (values > EMPTY * values[0])
    return Whitening(n, mean, q[:, wanted], values[wanted], trace, residual, rounds, passes.count)


def _ritz(basis: np.ndarray, image: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Ritz vectors and values, falling, and the largest residual of the first k."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q = basis @ turn
    off = np.linalg.norm(image @ turn - q * values, axis=0)[:k]
    return q, values, float(off.max() / values[0])


def _filtered(times: Callable, q: np.ndarray, low: float, cut: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial, scaled to one at the top, of the covariance times q."""
    middle, half = (low + cut) / 2, (cut - low) / 2
    scale = half / (top - middle)
    first = scale
    before, now = q, (times(q) - middle * q) * (scale / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - scale)
        step = (times(now) - middle * now) * (2 * after / half) - before * (scale * after)
        before, now, scale = now, step, after
    return now


def _lower_edge(times: Callable, start: np.ndarray) -> float:
    """A value about as low as the least eigenvalue, by Lanczos passes."""
    basis = [start / np.linalg.norm(start)]
    diagonal, beside = [], []
    for _ in range(min(LANCZOS, len(start))):
        image = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ image))
        for b in basis + basis:  # twice, to stay orthogonal
            image = image - (b @ image) * b
        beside.append(float(np.linalg.norm(image)))
        if beside[-1] < 1e-10 * abs(diagonal[0]):
            break
        basis.append(image / beside[-1])
    t = np.diag(diagonal) + np.diag(beside[: len(diagonal) - 1], 1) + np.diag(beside[: len(diagonal) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - beside[-1] * abs(vectors[-1, 0])))


def identity_error(passes: Passes, fitted: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity; one pass."""
    k = len(fitted.eigenvalues)
    if not k:
        return 0.0
    mean, onto = fitted.mean, fitted.components / np.sqrt(fitted.eigenvalues)

    def part(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ onto
        return np.concatenate((w.sum(0), (w.T @ w).ravel()))

    found = passes.total(part) / fitted.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(
    vectors: DataFrame, fitted: Whitening, vector: str = "embedding", keep: Sequence[str] = ("vec_id",)
) -> DataFrame:
    """The columns to keep, and `whitened`: each row along each component, with variance one."""
    kept = [name for name in keep if name != "whitened"]
    taken = vectors.select(
        *[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(kept)],
        F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double")).alias("whitened"),
    )
    mean, onto = fitted.mean, fitted.components / np.sqrt(fitted.eigenvalues)

    def project(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        along = (_matrix(batch) - mean) @ onto
        offsets = pa.array(np.arange(batch.num_rows + 1) * along.shape[1], pa.int32())
        made = pa.ListArray.from_arrays(offsets, pa.array(along.ravel(), pa.float64()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=batch.schema.names)

    return common.in_batches(taken, project, taken.schema, rows=ROWS).toDF(*kept, "whitened")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The last column's vectors as rows."""
    flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)
