"""Embeddings whitened along the leading components of their covariance, by spectral divide and conquer."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import written

SCALE = 256
COMPONENTS = 4
# Rows of vectors in one multiplication.
BLOCK = 2048
EPSILON = float(np.finfo(float).eps)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by the dynamically weighted Halley iteration (QDWH):
    by a QR factorisation while the weights are large, then by solving with I + c X'X."""
    size = len(a)
    x = a / max(float(np.linalg.norm(a)), np.finfo(float).tiny)
    # A bound from below of the least singular value; anything less is as good as zero.
    low = max(float(np.linalg.norm(x, -2)) * 0.9, EPSILON)
    for _ in range(40):
        low = min(low, 1.0)
        square = low * low
        root = np.cbrt(4 * (1 - square) / square**2)
        weight = math.sqrt(1 + root)
        a_k = weight + 0.5 * math.sqrt(max(8 - 4 * root + 8 * (2 - square) / (square * weight), 0.0))
        b_k = (a_k - 1) ** 2 / 4
        c_k = a_k + b_k - 1
        if c_k > 100:
            q, _ = np.linalg.qr(np.vstack([math.sqrt(c_k) * x, np.eye(size)]))
            new = b_k / c_k * x + (a_k - b_k / c_k) / math.sqrt(c_k) * (q[:size] @ q[size:].T)
        else:
            new = b_k / c_k * x + (a_k - b_k / c_k) * np.linalg.solve(np.eye(size) + c_k * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        change, x = float(np.linalg.norm(new - x)), new
        low = low * (a_k + b_k * square) / (1 + c_k * square)
        if change <= 1e-14 * math.sqrt(size) or (abs(low - 1) < 10 * EPSILON and change < 1e-6):
            break
    return x


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the eigenvectors above a shift, and their number.

    The mean eigenvalue has eigenvalues on both sides unless all are equal. A shift that hits an
    eigenvalue gives no projector; shifts beside it are then tried, and the best split is taken.
    """
    count, best = len(a), None
    mean = float(np.trace(a)) / count
    spread = float(np.linalg.norm(a - mean * np.eye(count))) / math.sqrt(count)
    for part in (0.0, 0.05, -0.05, 0.13, -0.13, 0.29, -0.29, 0.47, -0.47):
        projector = (polar(a - (mean + part * spread) * np.eye(count)) + np.eye(count)) / 2
        trace = float(np.trace(projector))
        k = round(trace)
        if not 0 < k < count or abs(trace - k) > 1e-6:
            continue
        # The projector's range by orthogonal iteration from a fixed start: its other values are 0.
        basis = np.linalg.qr(np.random.default_rng(count).standard_normal((count, count)))[0]
        for _ in range(2):
            basis = np.linalg.qr(np.hstack([projector @ basis[:, :k], basis[:, k:]]))[0]
        coupling = float(np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]))
        if best is None or coupling < best[0]:
            best = coupling, basis, k
        if coupling <= 50 * EPSILON * count * size:
            break
    return best[1:] if best else None


def eigenvectors(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Invariant subspaces are split by spectral projectors until one dimension is left; subspaces
    behind the first `most` eigenvalues are not split further.
    """
    a = (a + a.T) / 2
    size = float(np.linalg.norm(a))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    todo = [(a, np.eye(len(a)))]
    while todo and (most is None or len(values) < most):
        own, basis = todo.pop()
        count = len(own)
        apart = float(np.linalg.norm(own - np.diag(np.diag(own))))
        found = None
        if count > 1 and apart > EPSILON * size:
            found = _split(own, size)
        if found is None:
            order = np.argsort(-np.diag(own), kind="stable")
            values += np.diag(own)[order].tolist()
            vectors += [basis[:, i] for i in order]
            continue
        turn, k = found
        inner = turn.T @ own @ turn
        inner = (inner + inner.T) / 2
        todo.append((inner[k:, k:], basis @ turn[:, k:]))
        todo.append((inner[:k, :k], basis @ turn[:, :k]))  # the larger eigenvalues, next
    order = np.argsort(-np.array(values), kind="stable")[:most]
    columns = np.array(vectors).reshape(len(vectors), len(a)).T[:, order]
    if columns.size:
        columns = columns / np.linalg.norm(columns, axis=0)
        largest = columns[np.argmax(np.abs(columns), axis=0), np.arange(columns.shape[1])]
        columns = columns * np.where(largest < 0, -1.0, 1.0)
    return np.array(values)[order], columns


@dataclass(frozen=True)
class Whitening:
    """Counts and sums of the fitted vectors, and their leading components; sizes depend on the
    dimension alone, so it is small enough to go to every task."""

    count: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None = None

    @property
    def scales(self) -> np.ndarray:
        """What projections are multiplied by; NaN where a component has no variance."""
        least = len(self.sums) * EPSILON * max(float(self.values.max(initial=0.0)), 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > least, 1 / np.sqrt(self.values), np.nan)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.count for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.vectors * self.scales)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        largest = self.count * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, self.sums), default=0)
        if largest * largest * max(len(self.sums), 1) < 2**63:
            away = x * self.count - np.array(self.sums, dtype=np.int64)
            return (away * away).sum(axis=1).tolist()
        away = x.astype(object) * self.count - np.array(self.sums, dtype=object)
        return [d if d < 2**63 else None for d in (away * away).sum(axis=1).tolist()]


def _matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part, _matrix(part.column("x"), dimensions)


def _totals(vectors: DataFrame, dimensions: int, size: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all vectors of `part`, which gives `size` numbers for a block: added up in each task,
    then by place. What reaches the driver depends on the dimension alone."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for _, x in _blocks(batches, dimensions):
            total += part(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["parts"])

    sums = vectors.select("x").mapInArrow(added, "parts array<double>").select(F.posexplode("parts").alias("i", "value"))
    out = np.zeros(size)
    for row in sums.groupBy("i").agg(F.sum("value").alias("value")).collect():
        out[row.i] = row.value
    return out


def _count_and_sums(vectors: DataFrame, dimensions: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and exact sums by dimension."""
    kind = pa.decimal128(38, 0)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dimensions + 1)
        for _, x in _blocks(batches, dimensions):
            wide = x if int(np.abs(x.astype(float)).max(initial=0.0)) < 2**50 else x.astype(object)
            for i, value in enumerate([len(x), *wide.sum(axis=0).tolist()]):
                total[i] += value
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(kind))], names=["parts"])

    sums = vectors.select("x").mapInArrow(added, "parts array<decimal(38,0)>")
    sums = sums.select(F.posexplode("parts").alias("i", "value")).groupBy("i").agg(F.sum("value").alias("value"))
    values = {row.i: int(row.value) for row in sums.collect()}
    return values.get(0, 0), tuple(values.get(i + 1, 0) for i in range(dimensions))


def scaled(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, x of rows whose vector is not null and holds finite numbers only; entries as floor(256 c)."""
    vector = F.col(vector_column)
    infinite = F.lit(float("inf"))

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != infinite)

    whole = F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE).cast("bigint"))
    kept = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector.cast("array<double>"), finite)
    return embeddings.filter(F.coalesce(kept, F.lit(False))).select(F.col(id_column).alias("vec_id"), whole.alias("x"))


def fit(rows: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening:
    """Fitted on the distinct vectors of rows with x. Equal vectors are reduced before they are
    shuffled. Covariances are sums over vectors less their means, in tables; the matrix that is split
    into components has one entry for each two dimensions."""
    vectors = written(rows.select("x").distinct())
    count, sums = _count_and_sums(vectors, dimensions)
    mean = np.array([s / count for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        away = x - mean
        return (away.T @ away).ravel()

    covariance = _totals(vectors, dimensions, dimensions**2, products).reshape(dimensions, dimensions) / count
    values, columns = eigenvectors(covariance, components)
    model = Whitening(count, sums, float(np.trace(covariance)), values, columns)
    used = np.flatnonzero(~np.isnan(model.scales))
    if not len(used):
        return model
    size = len(used)
    means = _totals(vectors, dimensions, size, lambda x: model.whitened(x)[:, used].sum(axis=0)) / count

    def whitened_products(x: np.ndarray) -> np.ndarray:
        away = model.whitened(x)[:, used] - means
        return (away.T @ away).ravel()

    whitened = _totals(vectors, dimensions, size * size, whitened_products).reshape(size, size) / count
    error = float(np.abs(whitened - np.eye(size)).max())
    return Whitening(count, sums, model.trace, values, columns, error)


_REPORT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def apply(rows: DataFrame, model: Whitening, dimensions: int) -> DataFrame:
    """A row for each row of vec_id and x and each component."""
    id_type = rows.schema["vec_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.values)
        explained = [max(float(v), 0.0) / model.trace if model.trace > 0 else 0.0 for v in model.values]
        for part, x in _blocks(batches, dimensions):
            count = len(x)
            each = np.repeat(np.arange(count), k)
            white = model.whitened(x).ravel()
            deviations = model.deviations(x)
            columns = [
                part.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                pa.array(np.full(count * k, model.count)),
                pa.array([deviations[i] for i in each], pa.int64()),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained * count, pa.float64()),
                pa.array([model.identity_error] * (count * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", *(f.split()[0] for f in _REPORT.split(", "))])

    return rows.select("vec_id", "x").mapInArrow(report, f"vec_id {id_type}, {_REPORT}")


def whitened_embeddings(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds a null or an entry that is not finite are left out,
    as are vectors of another dimension than most have (of equally many, the higher one). Rows that
    repeat an id or a vector each have their results; null ids are kept. Of fewer dimensions than
    `components` there are fewer components. A component without variance has null in `whitened`,
    explains 0 and is no part of the identity error, which is null if no component has variance.
    A deviation beyond 64 bits is null. An empty table gives an empty one.
    """
    rows = written(scaled(embeddings, id_column, vector_column))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dimensions = sizes[0].d if sizes else 1
    rows = rows.filter(F.size("x") == dimensions)
    model = fit(rows, dimensions, components) if sizes else Whitening(0, (0,), 0.0, np.empty(0), np.empty((1, 0)))
    return apply(rows, model, dimensions)
