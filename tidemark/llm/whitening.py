"""Whitening of embeddings: the covariance over all rows in Spark, its leading eigenvectors by FEAST contour integration.

Vectors become whole numbers x = floor(1024 c) + 100000, so sums are exact: one job gives the number of rows and the sums
by dimension, a second one the products of entries after the nearest whole mean has been taken off. Each task adds up its own
rows and sends one matrix; what comes to the driver has as many cells as half a covariance matrix, whatever the rows.

FEAST (contour integration): the projector on the eigenvectors whose eigenvalues lie in an interval is the integral of
(z - V)^-1 around it. A block of random vectors is put through solves at the complex nodes of a Gauss quadrature on the
half circle above the interval, the result is made orthogonal, and Rayleigh-Ritz in its span gives pairs; the span
found is put through again until residuals are at rounding. Inertia (the signs of an LDL' factorisation of V - s) counts the
eigenvalues above s. It lays the intervals out, tells the block's size, and proves for every interval that none is missed; where
one is, the block is doubled, up to the whole space.

Defined results: rows are left out whose vector is null, holds a null, a non-finite entry or one of magnitude 2^30 or more (whole
numbers would not be exact), or has another number of entries than most rows have (the larger number on a tie); repeated
rows count and come back as often as they are there; a null id is kept. Components without variance (eigenvalue below
rounding) are not returned, so equal vectors, a single one, or none give an empty result. Equal eigenvalues have any
orthogonal vectors of their space, the same for all rows. The deviation is null where it does not fit a long. Vectors of any
length work; the driver holds a few matrices of their square. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.texts import map_batches

SCALE, SHIFT = 1024.0, 100_000
LARGEST = float(1 << 30)
COMPONENTS = 8
#: Nodes of the quadrature, rounds of projection before a block is enlarged, and the residual at which a pair is taken.
NODES, ROUNDS, RESIDUAL = 8, 12, 1e-13
#: Eigenvalues of an interval, where they can be told apart.
INTERVAL = 8


def inertia(a: np.ndarray) -> tuple[int, int]:
    """The number of negative and of zero eigenvalues of a symmetric matrix, by LDL' with pivots of one and two rows."""
    a = np.array(a, dtype=float)
    tiny = np.finfo(float).eps * max(np.abs(a).max(initial=0.0), np.finfo(float).tiny)
    negative = 0
    alpha = (1 + 17 ** 0.5) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = divmod(int(off.argmax()), len(a))
        if max(diagonal[i], off[r, s]) <= tiny:
            return negative, len(a)
        if diagonal[i] >= alpha * off[r, s]:
            rest = np.delete(np.arange(len(a)), i)
            negative += a[i, i] < 0
            column = a[rest, i]
            a = a[np.ix_(rest, rest)] - np.outer(column, column) / a[i, i]
        else:  # a block of two rows whose determinant is below zero has one negative eigenvalue
            pair, rest = [r, s], np.delete(np.arange(len(a)), [r, s])
            negative += 1
            columns = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
    return negative, 0


def count_above(v: np.ndarray, s: float) -> int:
    """Eigenvalues greater than s."""
    negative, zero = inertia(v - s * np.eye(len(v)))
    return len(v) - negative - zero


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, number of eigenvalues) of intervals from the top down that hold the `wanted` greatest eigenvalues."""
    reach = float(np.abs(v).sum(axis=1).max())
    low, high = -reach * (1 + 1e-9) - 1e-300, reach * (1 + 1e-9) + 1e-300
    a, b = low, high
    for _ in range(60):  # the largest number found above which there are enough
        m = (a + b) / 2
        if count_above(v, m) >= wanted:
            a = m
            if count_above(v, m) <= wanted + 2:
                break
        else:
            b = m
    todo, found = [(a, high, count_above(v, a), 0)], []
    while todo:
        lo, hi, above_lo, above_hi = todo.pop()
        inside = above_lo - above_hi
        if not inside:
            continue
        if inside <= INTERVAL or hi - lo <= 1e-9 * reach:
            found.append((lo, hi, inside))
            continue
        m = (lo + hi) / 2
        above = count_above(v, m)
        todo += [(lo, m, above_lo, above), (m, hi, above, above_hi)]
    return sorted(found, reverse=True)


def project(v: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The quadrature of the contour integral of (z - V)^-1 block around [low, high]."""
    centre, radius = (low + high) / 2, (high - low) / 2
    node, weight = np.polynomial.legendre.leggauss(NODES)
    total = np.zeros_like(block)
    eye = np.eye(len(v))
    for x, w in zip(node, weight):
        turn = np.exp(1j * np.pi / 2 * (1 - x))
        total += w / 2 * np.real(radius * turn * np.linalg.solve((centre + radius * turn) * eye - v, block.astype(complex)))
    return total


def rayleigh_ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors of V in the span of a block, after directions of it that are rounding only are left out."""
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    basis = left[:, size > size.max(initial=0.0) * 1e-13] if len(size) else left
    values, small = np.linalg.eigh(basis.T @ v @ basis)
    return values, basis @ small


def feast(v: np.ndarray, low: float, high: float, inside: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in (low, high], of which there are `inside`, and their unit vectors."""
    d, scale = len(v), float(np.abs(v).sum(axis=1).max())
    size = min(d, 2 * inside + 4)
    rng = np.random.default_rng(seed)
    while True:
        block = rng.standard_normal((d, size))
        for _ in range(ROUNDS):
            values, vectors = rayleigh_ritz(v, project(v, block, low, high) if size < d else np.eye(d))
            mine = (values > low) & (values <= high)
            residual = np.linalg.norm(v @ vectors[:, mine] - vectors[:, mine] * values[mine], axis=0)
            if mine.sum() == inside and (residual <= RESIDUAL * scale).all():
                return values[mine], vectors[:, mine]
            if size == d:  # the whole space: what lies within rounding of the ends may be on either side
                order = np.argsort(np.abs(values - (low + high) / 2))[:inside]
                return values[order], vectors[:, order]
            block = vectors
        size = min(d, 2 * size)


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` greatest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns; the entry of
    greatest magnitude of each vector is positive."""
    wanted = min(wanted, len(v))
    scale = float(np.abs(v).max(initial=0.0))
    if not wanted or not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    v = v / scale
    found = [feast(v, *each) for each in intervals(v, wanted)]
    # All at once: vectors of neighbouring intervals are made orthogonal to each other.
    values, vectors = rayleigh_ritz(v, np.concatenate([x for _, x in found], axis=1))
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order], vectors[:, order]
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return values * scale, vectors


@dataclass
class Whitening:
    """n rows with sums by dimension, the covariance's trace, and components by falling eigenvalue (vectors as columns)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """The vector as doubles in the first column, then `keep`, of rows without a null or non-finite entry."""
    value = vectors[vector].cast("array<double>")
    fine = F.forall(value, lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST), F.lit(False)))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(value, *[vectors[c] for c in keep])


def _matrix(column: pa.ListArray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of d entries, and their entries as whole numbers."""
    off = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(np.diff(off) == d)
    at = (off[:-1] - off[0])[rows]
    return rows, (np.floor(SCALE * flat[at[:, None] + np.arange(d)]) + SHIFT).astype(np.int64) if len(rows) else np.zeros((0, d), np.int64)


def products(y: np.ndarray) -> np.ndarray:
    """Y'Y of whole numbers below 2^42, exactly, as Python numbers."""
    total = np.zeros((y.shape[1],) * 2, dtype=object)
    small = int(np.abs(y).max(initial=0)) < 1 << 21
    parts = [(0, y)] if small else [(0, y & 0xFFFFF), (20, y >> 20)]
    for i in range(0, len(y), 512):  # sums of 512 products stay below 2^53
        held = [(bits, p[i : i + 512].astype(float)) for bits, p in parts]
        for bits, a in held:
            for more, b in held:
                total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << bits + more)
    return total


_CELLS = "i int, j int, value decimal(38,0)"


def _cells(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    i, j, value = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(v) for v in value], pa.decimal128(38, 0))], names=["i", "j", "value"])


def _added(cells: DataFrame) -> dict[tuple[int, int], int]:
    """Sums of cells (i, j) over all tasks: as many as a vector or half a matrix has."""
    return {(r.i, r.j): int(r.value) for r in cells.groupBy("i", "j").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()}


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable rows."""
    rows = usable(vectors, vector, [])
    name = rows.columns[0]
    most = rows.groupBy(F.size(name).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if most is None or not most.d:
        return Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    d, n = most.d, most.n

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, dtype=object)
        for batch in batches:
            total = total + _matrix(batch.column(0), d)[1].sum(axis=0).astype(object)
        yield _cells([(i, 0, int(v)) for i, v in enumerate(total)])

    held = _added(map_batches(rows, sums_of, _CELLS))
    sums = [held[i, 0] for i in range(d)]
    nearest = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def products_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            total = total + products(_matrix(batch.column(0), d)[1] - nearest)
        yield _cells([(i, j, int(total[i, j])) for i in range(d) for j in range(i, d)])

    held = _added(map_batches(rows, products_of, _CELLS))
    left = [s - n * int(c) for s, c in zip(sums, nearest)]  # sums of what was multiplied
    v = np.empty((d, d))
    for (i, j), value in held.items():
        v[i, j] = v[j, i] = (n * value - left[i] * left[j]) / (n * n)
    trace = sum(n * held[i, i] - left[i] * left[i] for i in range(d)) / (n * n)
    values, columns = leading(v, components)
    own = values > d * np.finfo(float).eps * trace
    model = Whitening(n, sums, trace, values[own], columns[:, own])
    if len(model.values):
        model.identity_error = _identity_error(rows, model)
    return model


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    mean = np.array([s / model.n for s in model.sums])
    return (x - mean) @ (model.vectors / np.sqrt(model.values))


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """The greatest difference between the covariance of the whitened rows, as they come out, and the identity."""
    k, d = len(model.values), model.dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _whitened(_matrix(batch.column(0), d)[1], model)
            first += w.sum(axis=0)
            second += w.T @ w
        cells = [(i, k, first[i]) for i in range(k)] + [(i, j, second[i, j]) for i in range(k) for j in range(k)]
        i, j, value = zip(*cells)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value)], names=["i", "j", "value"])

    total = np.zeros((k, k + 1))
    for r in map_batches(rows, run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[r.i, r.j] = r.value / model.n
    return float(np.abs(total[:, :k] - np.outer(total[:, k], total[:, k]) - np.eye(k)).max())


def deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """The sum over dimensions of (n x - S)^2 of every row, exactly; null beyond a long."""
    nearest = np.array([(2 * s + model.n) // (2 * model.n) for s in model.sums], dtype=np.int64)
    left = [s - model.n * int(c) for s, c in zip(model.sums, nearest)]
    y = x - nearest
    largest = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, left), default=0)
    if len(left) * largest * largest < 1 << 63:
        gap = model.n * y - np.array(left, dtype=np.int64)
        return pa.array((gap * gap).sum(axis=1))
    gap = model.n * y.astype(object) - np.array(left, dtype=object)
    return pa.array([v if v < 1 << 63 else None for v in map(int, (gap * gap).sum(axis=1))], pa.int64())


def whiten(vectors: DataFrame, model: Whitening, keep: list[str], vector: str = "embedding", prefix: str = "") -> DataFrame:
    """The columns `keep` of every usable row, its deviation and its whitened entries (an array, the first component first)."""
    made = [T.StructField(f"{prefix}deviation", T.LongType()), T.StructField(f"{prefix}whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([vectors.schema[c] for c in keep] + made)
    arrow = to_arrow_schema(schema)
    k, d = len(model.values), model.dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _matrix(batch.column(0), d)
            values = _whitened(x, model)
            entries = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k), pa.array(values.ravel())).cast(arrow.field(len(keep) + 1).type)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows)).columns[1:], deviations(x, model), entries], names=arrow.names)

    rows = usable(vectors, vector, keep)
    return map_batches(rows if k else rows.limit(0), run, schema)


def explained(model: Whitening) -> Column:
    """The share of the variance of each component, as an array."""
    return F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if len(model.values) else F.array().cast("array<double>")
