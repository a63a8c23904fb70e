"""Embedding whitening from a pivoted Cholesky factor and one-sided Jacobi rotations.

An entry ``c`` becomes the integer ``floor(64 * c) + 1000000``, so that sums are exact whatever the
order of the tasks. Spark makes three passes over the vectors, none of which shuffles one:

1. count and sums of every dimension;
2. the scatter about a centre. Each task subtracts the integer centre (the rounded mean) before it
   multiplies, so products stay small; Spark adds the tasks' cells up, and the fraction of the mean
   that the integer centre left is taken off exactly, in whole numbers;
3. the projection of every vector on the components.

Between 2 and 3 the driver holds one matrix of ``dimensions x dimensions``. The scatter is factored
as ``P' A P = L L'`` by Cholesky with the largest remaining diagonal as pivot. One-sided Jacobi then
rotates the columns of the triangular factor itself until they are orthogonal: their squared norms
are the eigenvalues and the normalised columns the components. The scatter is never multiplied out
again, so small eigenvalues keep their digits.

A fourth, optional pass measures the covariance of the whitened vectors: each task gives count, mean
and centred products, which are merged in groups of tasks about their common mean.

What grows: the driver and each task hold a few matrices of ``dimensions`` squared, whatever the
number of rows; a task's batch of vectors is taken in slices.

Edge cases: a null vector, one with a null, NaN or infinite entry, and one with an entry whose integer
needs more than 62 bits is dropped. All vectors have the dimension of the longest one left; a shorter
one lacks entries, which counts as null. Directions without variance have no component, so constant
or few vectors give fewer than ``components`` (a single vector none, and then no rows). A deviation
that does not fit a long is null. A null id is kept; repeated rows and ids count and are returned
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.llm.common import by_name, checkpointed, table

SCALE, SHIFT = 64, 1_000_000
#: Integers of at most so many bits are exact doubles.
EXACT = 2**53
#: Rows of a batch that are held as matrices at once.
SLICE = 4_096
#: Bits of a limb; three of them, added up as decimals, hold any cell of a scatter.
LIMB = 60


@dataclass
class Model:
    """Whitening of vectors: integer means and components (columns) with their eigenvalues."""

    n: int = 0
    sums: list[int] = field(default_factory=list)
    eigenvalues: np.ndarray = field(default_factory=lambda: np.zeros(0))
    components: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0

    @property
    def centre(self) -> list[int]:
        """The rounded means."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def explained(self) -> list[float]:
        return [float(e) / self.trace for e in self.eigenvalues]


def _matrix(column: pa.Array, dimensions: int | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of a list column that can be used, and their integers, grouped by length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    entries = lists.flatten().cast(pa.float64())
    values = entries.fill_null(math.nan).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))[:-1]]) if len(lengths) else lengths
    rows, blocks = [], []
    wanted = [dimensions] if dimensions is not None else sorted({int(n) for n in lengths if n > 0})
    for length in wanted:
        at = np.flatnonzero(lengths == length)
        if not length or not len(at):
            continue
        taken = values[starts[at][:, None] + np.arange(length)]
        whole = np.floor(SCALE * taken) + SHIFT
        good = (np.abs(whole) < 2.0**62).all(axis=1)  # false for NaN and infinite entries
        if good.any():
            rows.append(at[good])
            blocks.append(np.floor(SCALE * taken[good]).astype(np.int64) + SHIFT)
    return rows, blocks


def _slices(batches: Iterator[pa.RecordBatch], dimensions: int | None = None):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            rows, blocks = _matrix(part.column("vector"), dimensions)
            for own, block in zip(rows, blocks, strict=True):
                yield part, own, block


def _vectors(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    return embeddings.select(
        by_name(embeddings, key).alias("vec_id"),
        by_name(embeddings, vector).cast("array<double>").alias("vector"),
    )


def _limbs(value: int) -> tuple[int, int, int]:
    mask = (1 << LIMB) - 1
    return value & mask, (value >> LIMB) & mask, value >> (2 * LIMB)


def _added_up(df: DataFrame, function: Callable) -> dict[tuple[int, int], int]:
    """Exact sums of whole numbers that tasks give per pair of indices."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = function(batches)
        if found:
            keys = list(found)
            limbs = [_limbs(int(found[k])) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)),
                    *(pa.array([x[i] for x in limbs], pa.int64()) for i in range(3)),
                ],
                names=["i", "j", "a", "b", "c"],
            )

    summed = (
        df.mapInArrow(cells, "i int, j int, a long, b long, c long")
        .groupBy("i", "j")
        .agg(*(F.sum(F.col(x).cast("decimal(38,0)")).alias(x) for x in "abc"))
        .collect()  # a cell per pair of dimensions
    )
    return {
        (r.i, r.j): int(r.a) + (int(r.b) << LIMB) + (int(r.c) << (2 * LIMB)) for r in summed
    }


def _moments(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], int]:
    """Per length of vectors: the count (index -1) and the sum of each dimension."""
    found: dict[tuple[int, int], int] = {}
    for _, _, block in _slices(batches):
        length = block.shape[1]
        found[length, -1] = found.get((length, -1), 0) + len(block)
        # Halves of the integers add up without overflow.
        low, high = block & 0xFFFFFFFF, block >> 32
        sums = zip(low.sum(axis=0).tolist(), high.sum(axis=0).tolist(), strict=True)
        for j, (lo, hi) in enumerate(sums):
            found[length, j] = found.get((length, j), 0) + lo + (hi << 32)
    return found


def _products(block: np.ndarray, centre: list[int]) -> np.ndarray:
    """Exact products of the centred rows, summed."""
    far = max(
        max(abs(int(hi) - c), abs(int(lo) - c))
        for hi, lo, c in zip(block.max(axis=0), block.min(axis=0), centre, strict=True)
    )
    if far * far * len(block) < EXACT:
        small = (block - np.array(centre, dtype=np.int64)).astype(np.float64)
        return (small.T @ small).astype(np.int64)
    exact = block.astype(object) - np.array(centre, dtype=object)
    return exact.T @ exact


def _scatter_of(model: Model) -> Callable:
    dimensions, centre = len(model.sums), model.centre

    def scatter(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], int]:
        total = np.zeros((dimensions, dimensions), dtype=object)
        seen = False
        for _, _, block in _slices(batches, dimensions):
            total += _products(block, centre).astype(object)
            seen = True
        if not seen:
            return {}
        return {(i, j): total[i, j] for i in range(dimensions) for j in range(i, dimensions)}

    return scatter


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """``F`` with ``F F' = scatter``; its rows are the rows of a triangular factor, pivots undone.

    The largest remaining diagonal is the next pivot. What remains of a diagonal is nothing once it
    is within the rounding error of the whole one; columns end where nothing remains.
    """
    n = len(scatter)
    rest, order = scatter.astype(np.float64).copy(), np.arange(n)
    noise = 8 * n * np.finfo(np.float64).eps * rest.diagonal()
    lower = np.zeros((n, n))
    rank = 0
    for k in range(n):
        left = rest.diagonal()[k:]
        usable = left > noise[order[k:]]
        if not usable.any():
            break
        p = k + int(np.argmax(np.where(usable, left, -1.0)))
        if p != k:
            rest[[k, p]] = rest[[p, k]]
            rest[:, [k, p]] = rest[:, [p, k]]
            lower[[k, p], :k] = lower[[p, k], :k]
            order[[k, p]] = order[[p, k]]
        lower[k, k] = math.sqrt(rest[k, k])
        lower[k + 1 :, k] = rest[k + 1 :, k] / lower[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k + 1 :, k])
        rank = k + 1
    factor = np.zeros((n, rank))
    factor[order] = lower[:, :rank]
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``factor @ factor.T``.

    Pairs of columns are rotated until all are orthogonal to working precision. The sign of a
    component makes its largest entry positive.
    """
    columns = factor.T.copy()  # rows are contiguous
    k = len(columns)
    small = np.finfo(np.float64).eps * max(1.0, math.sqrt(factor.shape[0]))
    for _ in range(sweeps):
        rotated = False
        for p in range(k - 1):
            for q in range(p + 1, k):
                x, y = columns[p], columns[q]
                a, b, c = float(x @ x), float(y @ y), float(x @ y)
                if abs(c) <= small * math.sqrt(a) * math.sqrt(b):
                    continue
                rotated = True
                zeta = (b - a) / (2.0 * c)
                t = math.copysign(1.0, zeta) / (abs(zeta) + math.hypot(1.0, zeta))
                cos = 1.0 / math.hypot(1.0, t)
                sin = cos * t
                columns[p], columns[q] = cos * x - sin * y, sin * x + cos * y
        if not rotated:
            break
    else:
        raise RuntimeError(f"columns are not orthogonal after {sweeps} sweeps")
    norms = np.sqrt((columns * columns).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    vectors = (columns[order] / norms[order, None]).T
    if vectors.size:
        largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
        vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    return norms[order] ** 2, vectors


def fit(
    embeddings: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding"
) -> Model:
    """The whitening of all vectors of a table."""
    vectors = _vectors(embeddings, key, vector)
    moments = _added_up(vectors, _moments)
    if not moments:
        return Model()
    dimensions = max(length for length, _ in moments)
    n = moments[dimensions, -1]
    model = Model(n, [moments[dimensions, j] for j in range(dimensions)])
    cells = _added_up(vectors, _scatter_of(model))
    # The integer centre is off the mean by left / n: n * scatter - left left' is exact.
    left = [s - n * c for s, c in zip(model.sums, model.centre, strict=True)]
    scatter = np.zeros((dimensions, dimensions))
    trace = 0
    for (i, j), cell in cells.items():
        whole = n * cell - left[i] * left[j]
        scatter[i, j] = scatter[j, i] = whole / n
        trace += whole if i == j else 0
    model.trace = trace / n / n
    values, found = one_sided_jacobi(pivoted_cholesky(scatter))
    model.eigenvalues = values[:components] / n
    model.components = found[:, :components]
    return model


def _project(model: Model) -> Callable:
    """Whitened rows of a block of integers."""
    centre = np.array(model.centre, dtype=np.int64)
    off = np.array([(s - model.n * c) / model.n for s, c in zip(model.sums, model.centre, strict=True)])
    onto = model.components / np.sqrt(model.eigenvalues)
    reach = float(2**62)

    def project(block: np.ndarray) -> np.ndarray:
        near = np.abs(block.astype(np.float64) - centre.astype(np.float64)).max(initial=0.0) < reach
        centred = block - centre if near else block.astype(object) - centre.astype(object)
        return (centred.astype(np.float64) - off) @ onto

    return project


def _deviations(model: Model) -> Callable:
    """Exact sums of ``(n * x - sum) ** 2`` over the dimensions; null where a long cannot hold it."""
    n, sums = model.n, model.sums
    low, high = (np.array([(s + r) // n for s in sums], dtype=object) for r in (0, n - 1))

    def deviations(block: np.ndarray) -> list[int | None]:
        least, most = block.min(axis=0).astype(object), block.max(axis=0).astype(object)
        far = max(int(max(abs(a - x), abs(b - y))) for a, b, x, y in zip(least, most, high, low, strict=True))
        if (n * (far + 1)) ** 2 * len(sums) < 2**63:
            off = block - np.array([s // n for s in sums], dtype=np.int64)
            off = off * np.int64(n) - np.array([s % n for s in sums], dtype=np.int64)
            return (off * off).sum(axis=1).tolist()
        off = block.astype(object) * n - np.array(sums, dtype=object)
        return [d if d < 2**63 else None for d in (off * off).sum(axis=1).tolist()]

    return deviations


def transform(
    embeddings: DataFrame, model: Model, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array with a value per component) of every usable vector."""
    vectors = _vectors(embeddings, key, vector)
    if not len(model.eigenvalues):
        return vectors.where(F.lit(False)).select(
            "vec_id", F.lit(0).cast("long").alias("deviation"), F.col("vector").alias("whitened")
        )
    project, deviations, k = _project(model), _deviations(model), len(model.eigenvalues)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, block in _slices(batches, len(model.sums)):
            flat = pa.array(project(block).ravel())
            edges = pa.array(np.arange(0, len(block) * k + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(rows)),
                    pa.array(deviations(block), pa.int64()),
                    pa.ListArray.from_arrays(edges, flat),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(whiten, f"vec_id {kind}, deviation long, whitened array<double>")


def _merged(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Counts, means and centred products of several parts about their common mean."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    products = sum(p[2] + p[0] * np.outer(p[1] - mean, p[1] - mean) for p in parts)
    return n, mean, products


def covariance(
    embeddings: DataFrame,
    model: Model,
    key: str = "vec_id",
    vector: str = "embedding",
    group: int = 64,
) -> np.ndarray:
    """Covariance of the whitened vectors, centred within the tasks and merged ``group`` at a time."""
    k = len(model.eigenvalues)
    if not k:
        return np.zeros((0, 0))
    project = _project(model)

    def packed(found: tuple[int, np.ndarray, np.ndarray], task: int) -> pa.RecordBatch:
        n, mean, products = found
        return pa.RecordBatch.from_arrays(
            [
                pa.array([task], pa.int64()),
                pa.array([n], pa.int64()),
                pa.array([mean.tolist()], pa.list_(pa.float64())),
                pa.array([products.ravel().tolist()], pa.list_(pa.float64())),
            ],
            names=["task", "n", "mean", "products"],
        )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for _, _, block in _slices(batches, len(model.sums)):
            white = project(block)
            mean = white.mean(axis=0)
            own = (len(white), mean, (white - mean).T @ (white - mean))
            found = own if found is None else _merged([found, own])
        if found is not None:
            yield packed(found, TaskContext.get().partitionId())

    def unpacked(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray, np.ndarray]]:
        columns = (batch.column(c).to_pylist() for c in ("n", "mean", "products"))
        return [
            (n, np.array(m), np.array(p).reshape(k, k)) for n, m, p in zip(*columns, strict=True)
        ]

    def merge(table_: pa.Table) -> pa.Table:
        parts = [x for b in table_.to_batches() for x in unpacked(b)]
        first = min(table_.column("task").to_pylist())
        return pa.Table.from_batches([packed(_merged(parts), first // group)])

    schema = "task long, n long, mean array<double>, products array<double>"
    parts = checkpointed(_vectors(embeddings, key, vector).mapInArrow(measure, schema))
    while parts.count() > group:
        by = F.floor(F.col("task") / group).alias("by")
        parts = checkpointed(parts.groupBy(by).applyInArrow(merge, schema))
    rows = [(r.n, np.array(r["mean"]), np.array(r.products).reshape(k, k)) for r in parts.collect()]
    n, _, products = _merged(rows)
    return products / n


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's first 32 whitened components, with their shares and the error of the whole."""
    embeddings = table(spark, sf_dir, "embeddings")
    model = fit(embeddings)
    error = np.abs(covariance(embeddings, model) - np.eye(len(model.eigenvalues))).max(initial=0.0)
    shares = F.array(*(F.lit(x) for x in model.explained())).cast("array<double>")
    return (
        transform(embeddings, model)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            "vec_id",
            (F.col("place") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            shares[F.col("place")].alias("explained"),
            F.lit(float(error)).alias("identity_error"),
        )
    )
