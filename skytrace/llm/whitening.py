"""Whitening of embeddings by principal components.

1. Entries become whole numbers, so the sums of all dimensions are exact and the mean is known as a
   whole part and a remainder; tasks send counts and sums, merged in rounds.
2. Tasks add up products of centred rows, one matrix each; the matrices are merged in rounds.
3. The covariance, whose size depends on the dimensions only, is brought to tridiagonal form by
   Householder reflections. Sturm counts bisect the leading eigenvalues; inverse iteration gives
   their vectors, and vectors of close eigenvalues are made orthogonal to each other.
4. Mean and components are sent to all tasks, which project their rows.

Nulls and edges: a vector that is null or empty or has a null, an infinite entry, no number or an
entry of 2**52 or more is left out; so are vectors of another length than most have (of equally
frequent lengths the shorter counts). Rows with a null id and repeated rows count each. Components
without variance, that is within rounding errors of none, do not exist: a table of equal
vectors, or of a single one, gives no rows. Fewer dimensions give fewer components. A ``deviation``
that does not fit a long is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm.merging import merged
from skytrace.llm.text import column
from skytrace.session import written

COMPONENTS = 8
STEPS = 1024
SHIFT = 100_000
LIMIT = float(2 ** 52)
#: Rows whose products are added up at once.
BLOCK_ROWS = 4096
_EPSILON = np.finfo(float).eps

WHITENED = "vec_id bigint, deviation bigint, whitened array<double>"


# Eigenvectors of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, second diagonal and the Householder vectors, one a row, of a symmetric matrix."""
    a = np.array(matrix, float)
    size = len(a)
    mirrors = np.zeros((max(size - 2, 0), size))
    for k in range(size - 2):
        x = a[k + 1:, k]
        scale = np.abs(x).max()
        if scale == 0.0 or not np.abs(x[1:]).max() > 0.0:
            continue
        v = x / scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (p @ v) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2.0 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
        mirrors[k, k + 1:] = v
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), mirrors


def sturm_count(diagonal: np.ndarray, beside: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of the points."""
    squares = np.concatenate(([0.0], beside * beside))
    smallest = _EPSILON * max(float(np.abs(diagonal).max()), float(np.sqrt(squares.max())), 1e-290)
    pivot = np.ones(len(points))
    below = np.zeros(len(points), np.int64)
    for own, square in zip(diagonal, squares):
        pivot = own - points - square / pivot
        pivot = np.where(np.abs(pivot) < smallest, -smallest, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection of intervals that hold all of them."""
    size = len(diagonal)
    sides = np.abs(np.concatenate(([0.0], beside))) + np.abs(np.concatenate((beside, [0.0])))
    reach = float((diagonal + sides).max()), float((diagonal - sides).min())
    slack = _EPSILON * size * max(abs(reach[0]), abs(reach[1]), 1e-290)
    ranks = np.arange(size - 1, size - 1 - min(wanted, size), -1)  # eigenvalues below each
    low = np.full(len(ranks), reach[1] - slack)
    high = np.full(len(ranks), reach[0] + slack)
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return middle
        above = sturm_count(diagonal, beside, middle) <= ranks
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solve_shifted(diagonal: np.ndarray, beside: np.ndarray, shift: float,
                   right: np.ndarray, smallest: float) -> np.ndarray:
    """Solve ``(T - shift) y = right`` by elimination with exchanges of neighbouring rows."""
    size = len(diagonal)
    main = (diagonal - shift).tolist()
    upper = [*beside.tolist(), 0.0]
    second = [0.0] * size
    y = right.tolist()
    for i in range(size - 1):
        below = float(beside[i])
        if abs(main[i]) >= abs(below):
            if abs(main[i]) < smallest:
                main[i] = smallest
            factor = below / main[i]
            main[i + 1] -= factor * upper[i]
            y[i + 1] -= factor * y[i]
        else:
            factor = main[i] / below
            main[i], upper[i], main[i + 1], second[i], upper[i + 1] = (
                below, main[i + 1], upper[i] - factor * main[i + 1], upper[i + 1],
                -factor * upper[i + 1])
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
    for i in range(size - 1, -1, -1):
        if abs(main[i]) < smallest:
            main[i] = smallest
        after = upper[i] * y[i + 1] if i + 1 < size else 0.0
        if i + 2 < size:
            after += second[i] * y[i + 2]
        y[i] = (y[i] - after) / main[i]
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray,
                      values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a row; those of a cluster of eigenvalues are orthogonalised."""
    size = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(beside).max()) if len(beside) else 0.0)
    smallest = _EPSILON * max(norm, 1e-290)
    draw = np.random.default_rng(7)
    out = np.zeros((len(values), size))
    begin = 0  # first eigenvalue of the cluster
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            begin = i
        vector = draw.standard_normal(size)
        # Equal shifts would give equal vectors: they are moved apart by a few rounding errors.
        shift = value - 4.0 * smallest * (i - begin)
        for _ in range(6):
            for _ in range(2):
                vector = vector - out[begin:i].T @ (out[begin:i] @ vector)
            vector /= np.abs(vector).max()
            vector /= np.sqrt(vector @ vector)
            before, vector = vector, _solve_shifted(diagonal, beside, shift, vector, smallest)
            vector /= np.abs(vector).max()
        for _ in range(2):
            vector = vector - out[begin:i].T @ (out[begin:i] @ vector)
        out[i] = vector / np.sqrt(vector @ vector)
    return out


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit vectors, one a row.

    A vector's sign makes its largest entry positive.
    """
    scale = float(np.abs(matrix).max()) if matrix.size else 0.0
    if not scale > 0.0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    # Without the scale, squares of tiny or huge entries leave the range of doubles.
    diagonal, beside, mirrors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, beside, wanted)
    vectors = inverse_iteration(diagonal, beside, values)
    for mirror in mirrors[::-1]:
        vectors -= 2.0 * np.outer(vectors @ mirror, mirror)
    largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]
    return values * scale, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]


# Distributed sums


def _carried(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Halves of sums, the lower one below 2**32 again."""
    return high + (low >> 32), low & 0xFFFFFFFF


def _blocks(batches: Iterable[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of bounded size and their vectors as a matrix."""
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(begin, BLOCK_ROWS)
            yield part, column(part, name).flatten().to_numpy(
                zero_copy_only=False).reshape(part.num_rows, -1)


def _whole(entries: np.ndarray) -> np.ndarray:
    return np.floor(entries * STEPS).astype(np.int64) + SHIFT


def _sums(batches: Iterable[pa.RecordBatch]) -> pa.RecordBatch | None:
    rows, high, low = 0, None, None
    for _, entries in _blocks(batches, "entries"):
        x = _whole(entries)
        own = _carried((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))
        high, low = own if high is None else _carried(high + own[0], low + own[1])
        rows += len(x)
    return None if high is None else _sum_batch(rows, high, low)


def _sum_batch(rows: int, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([rows]), pa.array([high.tolist()]), pa.array([low.tolist()])],
        ["rows", "high", "low"])


def _sum_table(table: pa.Table) -> pa.Table:
    high, low = None, None
    for h, l in zip(table.column("high").to_pylist(), table.column("low").to_pylist()):
        h, l = np.array(h, np.int64), np.array(l, np.int64)
        high, low = (h, l) if high is None else _carried(high + h, low + l)
    return pa.Table.from_batches([_sum_batch(sum(table.column("rows").to_pylist()), high, low)])


def exact_sums(entries: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of whole numbers in every dimension."""
    table = merged(entries, _sums, _sum_table, "rows bigint, high array<bigint>, low array<bigint>")
    if not table.num_rows:
        return 0, []
    row = table.to_pylist()[0]
    return row["rows"], [(h << 32) + l for h, l in zip(row["high"], row["low"])]


def _matrix_batch(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([matrix.astype("<f8").tobytes()])], ["matrix"])


def _matrix_table(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(m.as_py(), "<f8") for m in table.column("matrix"))
    return pa.Table.from_batches([_matrix_batch(total)])


def _added(rows: DataFrame, products) -> np.ndarray:
    """The sum of what ``products`` makes of every task's blocks, flat."""
    def summarise(batches: Iterable[pa.RecordBatch]) -> pa.RecordBatch | None:
        total = None
        for made in products(batches):
            total = made if total is None else total + made
        return None if total is None else _matrix_batch(total)

    table = merged(rows, summarise, _matrix_table, "matrix binary")
    return np.frombuffer(table.column("matrix")[0].as_py(), "<f8")


@dataclass(frozen=True)
class Centre:
    """Mean of whole numbers in every dimension: ``whole + rest / rows``."""

    rows: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, rows: int, sums: list[int]) -> Centre:
        return cls(rows, np.array([s // rows for s in sums], np.int64),
                   np.array([s % rows for s in sums], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest / self.rows

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of squares of ``rows * x - sum``, exact; null beyond a long."""
        apart = x - self.whole
        rough = ((self.rows * apart.astype(float) - self.rest) ** 2).sum(axis=1)
        if not len(rough) or rough.max() < 2.0 ** 62:
            return pa.array(((self.rows * apart - self.rest) ** 2).sum(axis=1), pa.int64())
        exact = [sum((self.rows * int(a) - int(r)) ** 2 for a, r in zip(row, self.rest))
                 for row in apart]
        return pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64())


@dataclass(frozen=True)
class Whitening:
    """Centre of the fit list and the directions that have unit variance."""

    centre: Centre
    values: np.ndarray
    explained: np.ndarray
    directions: np.ndarray  # one a column, divided by the standard deviation


def usable(vectors: DataFrame, vec_id: str = "vec_id", entries: str = "embedding") -> DataFrame:
    """``vec_id`` and ``entries`` (doubles) of all vectors that can be whitened."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"),
                          F.col(entries).cast("array<double>").alias("entries"))
    rows = rows.where(F.forall("entries", lambda c: F.coalesce(F.abs(c) < LIMIT, F.lit(False))))
    sizes = rows.groupBy(F.size("entries").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), "size").first()
    return rows.where((F.size("entries") == (most["size"] if most else 0))
                      & (F.size("entries") > 0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Centre, eigenvalues and directions of ``usable`` rows; None without rows."""
    number, sums = exact_sums(rows.select("entries"))
    if not number:
        return None
    centre = Centre.of(number, sums)
    size = len(sums)

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, entries in _blocks(batches, "entries"):
            apart = centre.centred(_whole(entries))
            yield (apart.T @ apart).ravel()

    covariance = _added(rows.select("entries"), products).reshape(size, size) / number
    values, vectors = leading_pairs((covariance + covariance.T) / 2, components)
    total = float(np.trace(covariance))
    real = values > size * _EPSILON * total
    values, vectors = values[real], vectors[real]
    return Whitening(centre, values, values / total if total else values,
                     (vectors / np.sqrt(values)[:, None]).T)


def _project(batches: Iterable[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch, entries in _blocks(batches, "entries"):
        x = _whole(entries)
        found = model.centre.centred(x) @ model.directions
        ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "vec_id"), model.centre.deviations(x),
             pa.ListArray.from_arrays(ends, found.ravel())], ["vec_id", "deviation", "whitened"])


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id``, ``deviation`` and the array ``whitened`` of ``usable`` rows."""
    return rows.select("vec_id", "entries").mapInArrow(partial(_project, model=model), WHITENED)


def identity_error(whitened: DataFrame, rows: int, components: int) -> float:
    """Largest difference between the covariance of whitened rows and the identity."""
    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, found in _blocks(batches, "whitened"):
            yield found.sum(axis=0)

    mean = _added(whitened.select("whitened"), sums) / rows

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, found in _blocks(batches, "whitened"):
            yield ((found - mean).T @ (found - mean)).ravel()

    covariance = _added(whitened.select("whitened"), products).reshape(components, -1) / rows
    return float(np.abs(covariance - np.eye(components)).max())


def components(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component, with the fit's own figures beside it."""
    rows = usable(vectors)
    model = fit(rows, wanted)
    if model is None or not len(model.values):
        found, model = rows.select("vec_id", F.lit(None).cast("bigint").alias("deviation"),
                                   F.array().cast("array<double>").alias("whitened")), None
    else:
        found = written(transform(rows, model), "whitened")
    number = model.centre.rows if model else 0
    error = identity_error(found, number, len(model.values)) if model else 0.0
    shares = F.array(*[F.lit(float(e)) for e in (model.explained if model else [0.0])])
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(number).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
