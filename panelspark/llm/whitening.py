"""Embedding whitening: pivoted Cholesky, then one-sided Jacobi on its factor.

A component c of a vector becomes the whole number x = floor(scale * c) + offset.
Tasks sum the x, then the products of the deviations from the rounded means; all of
it in whole numbers, so the covariance V (divisor n) is the exact one, rounded
once, whatever the order of the sums. V is factored by Cholesky with the largest
remaining pivot first (it ends at the rank); one-sided Jacobi rotations of the
triangular factor's columns make them orthogonal. Their squared norms are the
eigenvalues, the normalised columns the components.

Bounds: what reaches the driver, and what goes to the tasks, has the square of the vectors'
length, whatever their number; the shuffles carry a row per pair of dimensions and
task. The vectors are read once for each of: lengths, sums, products, the covariance of the
result, and the result. No row is moved.

Defined results: vectors that are null, empty, or hold entries that are null, not
finite or too large for an exact x (beyond 2 ** 53) are left out, and so are
vectors of another length than most (of equally frequent lengths the longest
counts); a null id stays a null id; rows that repeat count as often as they
occur; dimensions without variance add nothing, and there are at most as many components
as V has rank, so a table of equal vectors has none and an empty table gives an
empty result; a deviation too large for a long is null; extra columns go through in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Largest number that x may be.
LARGEST = 2**53
MAX_LONG = 2**63 - 1
_EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation of vectors of one length."""

    size: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray  # a column each, in the order of the eigenvalues
    trace: float
    scale: int = SCALE
    offset: int = OFFSET

    @property
    def middle(self) -> list[int]:
        """The means, rounded."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order) with v[order][:, order] = factor @ factor.T, as many columns as the rank."""
    rest, d = v.copy(), len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(np.diag(v).max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(np.diag(rest)[k:]))
        if rest[p, p] <= least:
            return factor[:, :k], order
        for table in (rest, rest.T, factor, order):
            table[[k, p]] = table[[p, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times a rotation that makes its columns orthogonal.

    A sweep meets every pair of columns once, in rounds of disjoint pairs."""
    columns, count = factor.T.copy(), factor.shape[1]
    seats = list(range(count + count % 2))  # an odd one sits out
    enough = np.finfo(float).eps * max(1, np.sqrt(len(factor)))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if max(a, b) < count]
            p, q = (np.array(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int),) * 2
            a, b = columns[p], columns[q]
            alpha, beta, gamma = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            away = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, away.max(initial=0.0))
            turned = away > enough
            zeta = (beta - alpha) / np.where(turned, 2 * gamma, 1)
            t = np.where(turned, np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta)), 0.0)
            cosine = 1 / np.hypot(1, t)
            sine = cosine * t
            columns[p] = cosine[:, None] * a - sine[:, None] * b
            columns[q] = sine[:, None] * a + cosine[:, None] * b
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= enough:
            break
    return columns.T


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of ``v`` up to its rank, and unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(v)
    turned = orthogonal_columns(factor)
    norms = np.linalg.norm(turned, axis=0)
    by = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(turned)
    vectors[order] = turned / norms
    return norms[by] ** 2, vectors[:, by]


def _sound(vector: str, scale: int, offset: int) -> Column:
    most = (LARGEST - abs(offset)) / scale
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < most, F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fits, F.lit(False))


def _whole(column: pa.Array, size: int, scale: int, offset: int) -> np.ndarray:
    """x of a list column, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(len(column), size) + offset


def _exact_product(y: np.ndarray) -> np.ndarray:
    """y.T @ y in whole numbers, as Python numbers."""
    if float(np.abs(y).max(initial=0)) ** 2 * len(y) < 2**53:
        dense = y.astype(np.float64)  # all partial sums are whole numbers that a double holds
        return (dense.T @ dense).astype(np.int64).astype(object)
    return y.T.astype(object) @ y.astype(object)


def _cells(values: dict[tuple[int, int], object], kind: pa.DataType) -> pa.RecordBatch:
    i, j = zip(*values, strict=True) if values else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(values.values()), kind)], names=["i", "j", "value"]
    )


def _sums(size: int, scale: int, offset: int):
    """(i, -1, sum of x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=object)
        for batch in batches:
            x = _whole(batch.column(0), size, scale, offset)
            safe = np.abs(x).max(initial=0) < 2**62 // max(len(x), 1)
            total += x.sum(0).astype(object) if safe else x.astype(object).sum(0)
        yield _cells({(i, -1): Decimal(int(s)) for i, s in enumerate(total)}, pa.decimal128(38))

    return run


def _products(size: int, scale: int, offset: int, middle: list[int]):
    """(i, j, sum of the products of the deviations from ``middle``) for j <= i."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), dtype=object)
        for batch in batches:
            total += _exact_product(_whole(batch.column(0), size, scale, offset) - np.array(middle, dtype=np.int64))
        yield _cells(
            {(i, j): Decimal(int(total[i, j])) for i in range(size) for j in range(i + 1)}, pa.decimal128(38)
        )

    return run


def _collected(cells: DataFrame) -> dict[tuple[int, int], object]:
    """The sums of all tasks; as many as there are pairs of dimensions."""
    return {(r.i, r.j): r.value for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}


def fit_whitening(
    vectors: DataFrame, *, vector_col: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, offset: int = OFFSET,
) -> Whitening:
    """The transformation learnt from all sound vectors."""
    sound = vectors.select(F.col(f"`{vector_col}`").alias("vector")).where(_sound("vector", scale, offset))
    lengths = sound.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return Whitening(0, 0, (), np.zeros(0), np.zeros((0, 0)), 0.0, scale, offset)
    size, n = int(most["size"]), int(most["n"])
    rows = sound.where(F.size("vector") == size)
    cell = f"i int, j int, value {_EXACT}"
    found = _collected(rows.mapInArrow(_sums(size, scale, offset), cell))
    sums = tuple(int(found[i, -1]) for i in range(size))
    model = Whitening(size, n, sums, np.zeros(0), np.zeros((size, 0)), 0.0, scale, offset)
    left = [s - n * m for s, m in zip(sums, model.middle, strict=True)]  # sums of the deviations
    found = _collected(rows.mapInArrow(_products(size, scale, offset, model.middle), cell))
    v = np.empty((size, size))
    for (i, j), value in found.items():
        v[i, j] = v[j, i] = (n * int(value) - left[i] * left[j]) / (n * n)
    values, axes = principal(v)
    return Whitening(size, n, sums, values[:components], axes[:, :components], float(np.trace(v)), scale, offset)


class _Applied:
    """A model as the tasks use it."""

    def __init__(self, model: Whitening):
        self.model = model
        self.middle = np.array(model.middle if model.n else [], dtype=np.int64)
        self.left = [s - model.n * m for s, m in zip(model.sums, self.middle.tolist(), strict=True)]
        self.rest = np.array([t / model.n for t in self.left])  # mean less rounded mean
        self.axes = model.components / np.sqrt(model.eigenvalues)

    def deviations(self, column: pa.Array) -> np.ndarray:
        """x less the rounded means."""
        return _whole(column, self.model.size, self.model.scale, self.model.offset) - self.middle

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y - self.rest) @ self.axes

    def squares(self, y: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sum) ** 2, exactly."""
        largest = self.model.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.left), default=0)
        whole = np.int64 if largest * largest * self.model.size <= MAX_LONG else object
        z = y.astype(whole) * self.model.n - np.array(self.left, dtype=whole)
        return [int(s) if s <= MAX_LONG else None for s in (z * z).sum(1)]


def _spread(applied: _Applied):
    """(i, j, sum of products) and (i, -1, sum) of the whitened columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = applied.axes.shape[1]
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = applied.whitened(applied.deviations(batch.column(0)))
            total += w.T @ w
            sums += w.sum(0)
        cells = {(i, j): float(total[i, j]) for i in range(k) for j in range(i + 1)}
        yield _cells(cells | {(i, -1): float(s) for i, s in enumerate(sums)}, pa.float64())

    return run


def _rows(vectors: DataFrame, model: Whitening, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`").alias("vector")
    rows = vectors.select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns if c != vector_col]).alias("doc"), vector)
    return rows.where(_sound("vector", model.scale, model.offset) & (F.size("vector") == model.size))


def identity_error(vectors: DataFrame, model: Whitening, *, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    if not len(model.eigenvalues):
        return 0.0
    rows = _rows(vectors, model, vector_col).select("vector")
    found = _collected(rows.mapInArrow(_spread(_Applied(model)), "i int, j int, value double"))
    mean = {i: found[i, -1] / model.n for i in range(len(model.eigenvalues))}
    return max(
        abs(value / model.n - mean[i] * mean[j] - (i == j)) for (i, j), value in found.items() if j >= 0
    )


def whiten(vectors: DataFrame, model: Whitening, *, vector_col: str = "embedding") -> DataFrame:
    """(doc struct of the other columns, deviation, whitened array) of every sound vector."""
    rows = _rows(vectors, model, vector_col)
    applied = _Applied(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = applied.deviations(batch.column(1))
            w = applied.whitened(y)
            offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(applied.squares(y), pa.int64()), pa.ListArray.from_arrays(offsets, w.ravel())],
                names=["doc", "deviation", "whitened"],
            )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, deviation long, whitened array<double>")


def by_component(whitened: DataFrame, model: Whitening) -> DataFrame:
    """A row per vector and component: (doc, component, n, deviation, whitened, explained)."""
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
    each: Sequence[Column] = [F.posexplode("whitened").alias("place", "value")]
    return whitened.select("doc", "deviation", *each).select(
        "doc",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(explained, F.col("place") + 1).alias("explained"),
    )
