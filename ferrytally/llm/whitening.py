"""Whitening of embeddings: principal components by Jacobi-Davidson, without ever forming the covariance matrix.

Entries are put on a grid of integers, ``floor(64 c) + 1000000``, and each distinct grid vector counts once: that is the
fit list, a table in the shared folder. The covariance is known through products only. One product is one Spark job: every task
centres its vectors and multiplies them with a block of columns, and the partial products (dimensions x columns numbers) are added up.
A block holds all components that have not converged, so that one pass over the fit list serves all of them.

On the driver are the columns of the search space, as long as a vector, never a row of the table:

* Rayleigh-Ritz in the search space gives the wanted pairs and their residuals;
* converged pairs are locked, in falling order, and everything later is kept orthogonal to them;
* for the others the correction equation, projected against the locked columns and the pair's own, is solved roughly by a few
  steps of MINRES, all pairs at once, and the solutions widen the search space, which is cut back when it is too wide.

It ends when all residuals are at double precision (512 units of rounding of the largest eigenvalue).

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped, as are vectors without entries and, if lengths differ,
vectors that have not the most frequent length (of equally frequent ones the longest). Grid values are kept within 2^53. Null and repeated ids are
rows like any other. Components without variance (up to 1e-12 of the trace) cannot be whitened and are left out, so a single distinct
vector or an empty table gives no rows. A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import map_arrow, stored, table

#: The grid that a vector's entries are put on.
STEPS = 64
OFFSET = 1_000_000

LARGEST = float(1 << 53)
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Solver:
    components: int = 16
    extra: int = 8  # columns of the first search space beyond the components
    inner: int = 5  # MINRES steps for a correction
    widest: int = 96  # columns of the search space before it is cut back
    rounds: int = 80
    precision: float = 512 * np.finfo(float).eps
    seed: int = 11


def on_grid(vector: Column) -> Column:
    """The grid vector (array of long); null where the vector cannot be used."""
    entries = vector.cast("array<double>")
    usable = F.coalesce(
        (F.size(entries) > 0) & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False)
    )
    within = lambda c: F.greatest(F.least(c * F.lit(float(STEPS)), F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when(usable, F.transform(entries, lambda c: F.floor(within(c)).cast("bigint") + F.lit(OFFSET).cast("bigint")))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, size)


def _added(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int, out: int) -> np.ndarray:
    """The sum of ``part(vectors)``, ``out`` numbers, over all vectors of the fit list; tasks send one sum each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(out)
        for b in batches:
            if b.num_rows:
                total += part(_matrix(b, size))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    # Bounded: as many rows as the model has numbers, whatever the table.
    found = fit.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    sums = np.zeros(out)
    sums[found.column("i").to_numpy()] = found.column("v").to_numpy()
    return sums


def _sums(fit: DataFrame, size: int) -> list[int]:
    """Exact sums per dimension, in two halves of 32 bits so that nothing overflows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            x = _matrix(b, size)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(high), pa.array(low)], names=["i", "h", "l"])

    rows = fit.mapInArrow(run, "i int, h bigint, l bigint").groupBy("i").agg(F.sum("h").alias("h"), F.sum("l").alias("l")).collect()
    return [(r["h"] << 32) + r["l"] for r in sorted(rows)]


def _unit(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.linalg.norm(columns, axis=0)
    return columns / np.where(length > 0, length, 1), length


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of one symmetric system for each column of ``rhs``, all with the same calls of ``apply``."""
    v, beta = _unit(rhs)
    eta, link = beta, np.zeros_like(beta)
    before, x = np.zeros_like(rhs), np.zeros_like(rhs)
    d, d_before = np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_before = np.ones_like(beta)
    s = s_before = np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - link * before
        following, beta = _unit(p)
        third, second, first = s_before * link, s * alpha + c_before * c * link, c * alpha - c_before * s * link
        turned = np.hypot(first, beta)
        safe = np.where(turned > 0, turned, 1)
        c_before, s_before, c, s = c, s, first / safe, beta / safe
        d_before, d = d, np.where(turned > 0, (v - third * d_before - second * d) / safe, 0)
        x = x + c * eta * d
        eta = -s * eta
        before, v, link = v, following, beta
    return x


def _outside(columns: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """``columns`` less their parts in orthonormal ``spaces``; twice, against rounding."""
    for _ in range(2):
        for space in spaces:
            columns = columns - space @ (space.T @ columns)
    return columns


def _widened(columns: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``columns`` add to the spaces."""
    columns, _ = _unit(columns)
    columns, length = _unit(_outside(columns, *spaces))
    left, singular, _ = np.linalg.svd(columns[:, length > 1e-12], full_matrices=False)
    new, length = _unit(_outside(left[:, singular > 1e-8], *spaces))
    return new[:, length > 0.5]


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], size: int, solver: Solver = Solver()) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors (columns) of a symmetric matrix known by its products."""
    wanted = min(solver.components, size)
    rng = np.random.default_rng(solver.seed)
    basis = np.linalg.qr(rng.standard_normal((size, min(size, wanted + solver.extra))))[0]
    image = product(basis)
    locked, values = np.empty((size, 0)), np.empty(0)
    least, stuck = np.inf, 0
    for _ in range(solver.rounds):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        near, rest = basis[:, : wanted - len(values)], theta[: wanted - len(values)]
        residual = _outside(image[:, : len(rest)] - near * rest, locked)
        size_of = np.linalg.norm(residual, axis=0)
        scale = max(abs(values[0]) if len(values) else abs(theta[0]), np.finfo(float).tiny)
        stuck, least = (stuck + 1, least) if size_of.max() > 0.5 * least else (0, size_of.max())
        done = size_of <= solver.precision * scale
        if stuck >= 4:  # rounding lets it go no further
            done |= size_of <= 8 * solver.precision * scale
        run = len(done) if done.all() else int(np.argmin(done))
        locked, values = np.hstack([locked, near[:, :run]]), np.concatenate([values, rest[:run]])
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        if run:
            least, stuck = np.inf, 0
        near, rest, residual = near[:, run:], rest[run:], residual[:, run:]
        basis, image = basis[:, run:], image[:, run:]
        if basis.shape[1] + near.shape[1] > solver.widest:
            keep = wanted - len(values) + solver.extra
            basis, image = basis[:, :keep], image[:, :keep]

        def projected(v: np.ndarray, near=near, rest=rest) -> np.ndarray:
            out = product(v) - rest * v
            out = _outside(out, locked)
            return out - near * (near * out).sum(axis=0)

        new = _widened(minres(projected, -residual, solver.inner * (1 + stuck)), locked, basis)
        if not new.shape[1]:
            new = _widened(rng.standard_normal((size, len(rest))), locked, basis)
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    raise RuntimeError(f"{wanted - len(values)} components did not converge in {solver.rounds} rounds")


@dataclass(frozen=True)
class Whitening:
    """A fitted model: its size depends on the dimensions alone."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray  # a column for each component
    trace: float
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        return centre(self.n, self.sums)


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as an integer and a fraction, so that centred entries lose nothing."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole)])


def dimensions(grid: DataFrame) -> int:
    """The most frequent length of ``x``; 0 without rows."""
    found = grid.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return found["d"] if found else 0


def fitted(grid: DataFrame, size: int, solver: Solver = Solver()) -> Whitening | None:
    """The components of the distinct grid vectors ``x``, all of length ``size``; None without variance."""
    fit = stored(grid.select("x").distinct())
    n = fit.count()
    if not n or not size:
        return None
    sums = _sums(fit, size)
    whole, part = centre(n, sums)

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - part

    trace = float(_added(fit, lambda x: (centred(x) ** 2).sum(axis=0), size, size).sum() / n)
    if not trace > 0:
        return None

    def product(block: np.ndarray) -> np.ndarray:
        def part_of(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return (y.T @ (y @ block)).ravel()

        return _added(fit, part_of, size, block.size).reshape(block.shape) / n

    values, vectors = eigenpairs(product, size, solver)
    kept = values > NO_VARIANCE * trace
    values, vectors = values[kept], vectors[:, kept]
    weights, k = vectors / np.sqrt(values), len(values)

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ weights
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    added = _added(fit, spread, size, k + k * k) / n
    covariance = added[k:].reshape(k, k) - np.outer(added[:k], added[:k])
    return Whitening(n, sums, values, vectors, trace, float(np.abs(covariance - np.eye(k)).max()))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact; null beyond a long."""
    away = np.abs(x.astype(float) * n - np.array(sums, float)).max(initial=0)
    if max(away * away * max(1, len(sums)), float(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0)) < 2.0**62:
        return pa.array(((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1))
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whitened(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", solver: Solver = Solver()) -> DataFrame:
    """A row for each usable vector and component: the key, the component's number, what it explains and the whitened value."""
    usable = vectors.select(F.col(f"`{key}`").alias("id"), on_grid(F.col(f"`{column}`")).alias("x")).filter("x is not null")
    size = dimensions(usable)
    usable = usable.filter(F.size("x") == size)
    model = fitted(usable, size, solver)
    kind = usable.schema["id"].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    whole, part = model.centre()
    weights, k = model.vectors / np.sqrt(model.values), len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, rows = _matrix(b, size), b.num_rows
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                b.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n, np.int64)), deviations(x, model.n, model.sums).take(each),
                pa.array((((x - whole) - part) @ weights).ravel()), pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, model.identity_error)),
            ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(usable, run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
