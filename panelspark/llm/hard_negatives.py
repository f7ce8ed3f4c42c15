"""Hard-negative mining with an angular triangle filter.

Components become whole numbers floor(scale * c); a score is a whole inner product.
The angles of every vector to a few reference directions are stored beside it. By the
triangle inequality on the sphere the angle between two vectors lies between the
largest difference and the smallest sum of their angles to any reference (the sum
taken the short way round), which gives an interval of cosines and, times the norms
and widened for rounding, bounds of the score. Two passes use the bounds, and only pairs
whose bounds overlap a pass's window get a whole-number score:

1. positives: of each anchor's rows of its label in a block, those whose upper bound
   reaches the k-th largest lower bound;
2. negatives: rows of another label whose bounds meet one of the windows
   [low % , high %] of the anchor's positive scores.

References are chosen far apart among ``SAMPLE`` vectors (those with the smallest
hashes of their ids); any choice gives right results, a good one narrow bounds.

Anchors are a query set against all rows, in blocks: a task compares a block of
about ``BLOCK`` rows with a slab of about ``SLAB`` anchors, which it
streams in chunks of ``CHUNK``, and passes on only the best of each anchor, so neither its memory
nor its input grows with the table, with a label's share or with groups of copies;
the number of tasks does, with the product of rows and anchors.

Defined results: rows with a null id, label or vector, an empty vector, or with a component that is
null or not finite, or whose squared norm does not fit a long, take no part; vectors of different
lengths have no score with each other; of rows that repeat an id the one with the
smallest (label, vector) counts; ties go by the smaller id; positives with a negative score have no
negatives; anchors without positives, and empty tables, give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import stored

SCALE = 256
REFERENCES, SAMPLE = 16, 1024
BLOCK, SLAB, CHUNK = 4096, 1 << 16, 256
#: What an angle may be off by rounding: the arc cosine of a number that is off by 1e-15 near 1.
ANGLE_PAD = 1e-6
#: What a bound may be off by rounding, relative to the norms, and in any case.
RELATIVE_PAD, PAD = 1e-12, 1.0
_ROW = "vec_id long, label long, entries array<long>, norm double, angles array<double>"


def far_apart(unit: np.ndarray, count: int) -> np.ndarray:
    """Rows of ``unit`` picked one by one, each the farthest from those picked."""
    picked, nearest = [0], unit @ unit[0]
    while len(picked) < min(count, len(unit)):
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    return unit[picked]


def _lists(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of the lists."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = []
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        part = column if len(at) == len(sizes) else column.take(pa.array(at))
        out.append((at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)


def _prepare(scale: int, references: dict[int, np.ndarray]):
    """Whole-number entries, norms and angles to the references; rows whose norm is too large go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _lists(batch.column(2)):
                scaled = np.floor(vectors.astype(np.float64) * scale)
                fits = (scaled * scaled).sum(1) < 2.0**62  # so any inner product fits a long
                at, entries = at[fits], scaled[fits].astype(np.int64)
                base = references.get(entries.shape[1], np.eye(REFERENCES, entries.shape[1]))
                angles = np.arccos(np.clip(_unit(entries) @ base.T, -1, 1))
                pick = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pick), batch.column(1).take(pick), _list_array(entries),
                     pa.array(np.linalg.norm(entries.astype(np.float64), axis=1)), _list_array(angles)],
                    names=["vec_id", "label", "entries", "norm", "angles"],
                )

    return run


def _list_array(table: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * table.shape[1], pa.int32()), table.ravel())


@dataclass
class Rows:
    """Vectors of one length."""

    ids: np.ndarray
    labels: np.ndarray
    entries: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    scores: list | None = None  # (positive, score) pairs of anchors

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at) -> Rows:
        return Rows(*[getattr(self, n)[at] for n in ("ids", "labels", "entries", "norms", "angles")])


def score_bounds(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of all pairs."""
    near = np.zeros((len(a), len(b)))
    far = np.full((len(a), len(b)), np.pi)
    for r in range(a.angles.shape[1]):
        x, y = a.angles[:, r, None], b.angles[None, :, r]
        np.maximum(near, np.abs(x - y), out=near)
        total = x + y
        np.minimum(far, np.minimum(total, 2 * np.pi - total), out=far)
    norms = a.norms[:, None] * b.norms[None, :]
    slack = norms * RELATIVE_PAD + PAD
    low = norms * np.cos(np.minimum(far + ANGLE_PAD, np.pi)) - slack
    return low, norms * np.cos(np.maximum(near - ANGLE_PAD, 0)) + slack


def scores(a: Rows, b: Rows) -> np.ndarray:
    """Whole inner products. In doubles where all partial sums, which the norms bound, are exact in them."""
    if a.norms.max(initial=0) * b.norms.max(initial=0) < 2**52:
        return (a.entries.astype(np.float64) @ b.entries.T.astype(np.float64)).astype(np.int64)
    return a.entries @ b.entries.T


def _scored(a: Rows, b: Rows, window: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows in its window, their scores), best first, ties by id."""
    used = np.flatnonzero(window.any(0))
    if not len(used):
        return
    part = b.take(used)
    values = scores(a, part)
    for i in range(len(a)):
        at = np.flatnonzero(window[i, used])
        if len(at):
            found = values[i, at]
            order = np.lexsort((part.ids[at], -found))
            yield i, part.ids[at[order]], found[order]


def find_positives(count: int):
    def find(a: Rows, b: Rows) -> Iterator[tuple]:
        low, high = score_bounds(a, b)
        same = (a.labels[:, None] == b.labels[None, :]) & (a.ids[:, None] != b.ids[None, :])
        low[~same] = -np.inf
        k = len(b) - count
        least = np.partition(low, k, axis=1)[:, k, None] if k >= 0 else -np.inf
        for i, ids, found in _scored(a, b, same & (high >= least)):
            for row, score in zip(ids[:count].tolist(), found[:count].tolist(), strict=True):
                yield int(a.ids[i]), row, score

    return find


def find_negatives(count: int, low_percent: int, high_percent: int):
    def find(a: Rows, b: Rows) -> Iterator[tuple]:
        low, high = score_bounds(a, b)
        windows = [
            [(p, s, -(-low_percent * s // 100), high_percent * s // 100) for p, s in pairs] for pairs in a.scores
        ]
        window = np.zeros(low.shape, dtype=bool)
        for i, each in enumerate(windows):
            for _, _, least, most in each:
                if least <= most:
                    window[i] |= (high[i] >= least) & (low[i] <= most)
        window &= a.labels[:, None] != b.labels[None, :]
        for i, ids, found in _scored(a, b, window):
            falling = -found
            for positive, score, least, most in windows[i]:
                start, stop = np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right")
                stop = min(start + count, stop)
                for row, value in zip(ids[start:stop].tolist(), found[start:stop].tolist(), strict=True):
                    yield int(a.ids[i]), positive, score, row, value

    return find


def _rows_of(batch: pa.RecordBatch) -> dict[int, Rows]:
    """The batch by length of the vectors."""
    column = {n: batch.column(n) for n in batch.schema.names}
    plain = {n: column[n].to_numpy(zero_copy_only=False) for n in ("vec_id", "label", "norm")}
    found = {}
    for at, entries in _lists(column["entries"]):
        pick = pa.array(at)
        angles = column["angles"].take(pick).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        rows = Rows(plain["vec_id"][at], plain["label"][at], entries, plain["norm"][at], angles)
        rows.scores = [[(s["id"], s["score"]) for s in x or ()] for x in column["wanted"].take(pick).to_pylist()]
        found[entries.shape[1]] = rows
    return found


def _joined(parts: list[Rows]) -> Rows:
    return Rows(*[np.concatenate([getattr(p, n) for p in parts]) for n in ("ids", "labels", "entries", "norms", "angles")])


def _compare(find: Callable[[Rows, Rows], Iterator[tuple]], names: list[str]):
    """Sorted rows of (block, slab), the block's rows before the anchors -> what ``find`` finds."""

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block, found = None, {}, {}, []
        for batch in batches:
            marks = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("block", "slab", "kind")])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if start == stop:
                    continue
                if key != (now := tuple(marks[:2, start].tolist())):
                    key, parts, block = now, {}, {}
                if marks[2, start] == 0:
                    for size, rows in _rows_of(batch.slice(start, stop - start)).items():
                        parts.setdefault(size, []).append(rows)
                    continue
                if parts:
                    block, parts = {size: _joined(p) for size, p in parts.items()}, {}
                for at in range(start, stop, CHUNK):
                    for size, anchors in _rows_of(batch.slice(at, min(CHUNK, stop - at))).items():
                        if size in block:
                            found.extend(find(anchors, block[size]))
                    if len(found) > 10_000:
                        yield table(found)
                        found = []
        yield table(found)

    return run


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, slabs: int, find, names: list[str]) -> DataFrame:
    """``find`` over all blocks of rows and slabs of anchors."""

    def dealt(df: DataFrame, salt: int, parts: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    columns = ["vec_id", "label", "entries", "norm", "angles", "wanted"]
    left = rows.withColumn("wanted", F.lit(None).cast("array<struct<id: bigint, score: bigint>>")).select(
        *columns, F.lit(0).alias("kind"), dealt(rows, 1, blocks).alias("block"), every(slabs).alias("slab")
    )
    right = anchors.select(
        *columns, F.lit(1).alias("kind"), dealt(anchors, 2, slabs).alias("slab"), every(blocks).alias("block")
    )
    together = left.unionByName(right).repartition("block", "slab").sortWithinPartitions("block", "slab", "kind")
    return together.mapInArrow(_compare(find, names), ", ".join(f"{n} long" for n in names))


def _references(sound: DataFrame, scale: int) -> dict[int, np.ndarray]:
    """Reference directions for each length in a sample of ``SAMPLE`` vectors."""
    first = sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector")
    by: dict[int, list] = {}
    for row in first.collect():
        by.setdefault(len(row.vector), []).append(row.vector)
    found = {}
    for size, vectors in by.items():
        unit = _unit(np.asarray(vectors, dtype=np.float64))
        unit = unit[np.isfinite(unit).all(1) & unit.any(1)]
        if len(unit):
            found[size] = far_apart(unit, REFERENCES)
    return found


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = SCALE,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says of a row (columns vec_id, label, vector) whether it is a query."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").alias("vector"),
    )
    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    sound = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite)
    single = sound.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.*")
    prepared = stored(
        single.select("vec_id", "label", "vector").mapInArrow(_prepare(scale, _references(sound, scale)), _ROW)
        .withColumn("anchor", F.coalesce(anchors, F.lit(False))),
        "angles",
    )
    sizes = prepared.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks, slabs = max(1, -(-sizes["rows"] // BLOCK)), max(1, -(-sizes["anchors"] // SLAB))
    queries = prepared.where("anchor")
    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    best = _meet(
        prepared, queries.withColumn("wanted", none), blocks, slabs, find_positives(positives),
        ["anchor_id", "positive_id", "positive_score"],
    )
    place = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    wanted = (
        best.withColumn("place", F.row_number().over(place)).where(F.col("place") <= positives)
        .groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("wanted"))
    )
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    near = _meet(
        prepared, queries.join(wanted, "vec_id"), blocks, slabs, find_negatives(negatives, low_percent, high_percent), names
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
