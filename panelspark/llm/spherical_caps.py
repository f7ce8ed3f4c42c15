"""Embedding near-dedup with spherical-cap filters.

A filter is a direction; a vector belongs to it if it lies in the cap around
the direction. Directions come from structured random product codes: the space
is turned by a random rotation and halved, each half has ``codewords`` random
unit vectors, and every combination of two of them is a direction, so
``rotations * codewords ** 2`` directions need only 2 * ``codewords`` products a
rotation. A vector is list-decoded: the scores of its halves, one of them
sorted, give all directions whose cap it exceeds, without trying each of them.
The best direction of every rotation is on the list in any case. Near vectors
share a filter with high probability and all that share one are compared: every
reported link is verified by cosine in double precision.

Caps and directions follow the number of vectors: a cap holds the share of the
sphere that gives it ``members`` of them, and there are as many directions as
put a vector into ``lists`` caps (for vectors in all directions alike). So filters keep
their size, lists keep their length, and what is shuffled is linear in the
vectors. Of random pairs at cosine 0.95, 0.998 or more meet (tested for 500 to
1,000,000 vectors of length 33, 64 and 96), closer ones more often.

Equal vectors are one node with a weight. The members of a filter are dealt to
blocks of about ``BLOCK`` and the blocks compared in pairs as matrix products, so no
task holds more than two blocks, and what leaves a task is linear in its rows: the number of links of
each vector and the edges of a spanning star per group. A pair that meets in
several filters counts in the smallest of them.

Defined results: vectors that are null, zero, empty, or hold null or non-finite
components link with nothing; vectors of different lengths do not link; rows of
one vec_id are vectors of their own in ``n_links``, and one node among
components; a null vec_id has a null component; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import connected_components, saved

THRESHOLD = 0.95
#: Caps a vector is in, vectors in a cap, rotations, and the largest share of the sphere in a cap.
LISTS, MEMBERS, ROTATIONS, WIDEST = 64, 60, 8, 0.05
BLOCK = 1024
SEED = 20


def cap_share(vectors: int, members: int = MEMBERS) -> float:
    """Share of the sphere in a cap that holds ``members`` of that many vectors."""
    return min(WIDEST, members / max(vectors, 1))


def cap_cosine(size: int, share: float) -> float:
    """Cosine that a random vector of the length exceeds with the probability ``share``."""
    t = np.linspace(0, 1, 1 << 17)
    density = (1 - t * t) ** ((max(size, 3) - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return float(t[np.searchsorted(-above, -2 * share * above[0])])


class Caps:
    """The product codes of one vector length."""

    def __init__(self, size: int, share: float, rotations: int = ROTATIONS, lists: int = LISTS):
        self.size, self.least = size, cap_cosine(size, share)
        self.codewords = int(np.ceil(np.sqrt(lists / share / rotations)))
        self.half = (size + 1) // 2
        self.turns, self.codes = [], []
        for r in range(rotations):
            rng = np.random.default_rng([SEED, size, r])
            q, upper = np.linalg.qr(rng.normal(size=(2 * self.half, 2 * self.half)))
            self.turns.append(q * np.sign(np.diag(upper)))
            code = rng.normal(size=(2, self.codewords, self.half))
            self.codes.append(code / np.linalg.norm(code, axis=2, keepdims=True))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted filters of each row of ``unit``."""
        padded = np.pad(unit, ((0, 0), (0, 2 * self.half - self.size)))
        found = [[] for _ in range(len(unit))]
        limit = self.least * np.sqrt(2)
        for r, (turn, code) in enumerate(zip(self.turns, self.codes, strict=True)):
            turned = padded @ turn
            first = turned[:, : self.half] @ code[0].T
            second = turned[:, self.half :] @ code[1].T
            falling = np.argsort(-second, axis=1)
            best = first.argmax(1) * self.codewords + falling[:, 0]
            # only first halves that can still reach the limit with the best second half
            reach = first + second.max(1, keepdims=True) >= limit
            for i in range(len(unit)):
                rows, by_score = np.flatnonzero(reach[i]), falling[i]
                n = np.searchsorted(-second[i, by_score], first[i, rows] - limit, side="right")
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                ids = np.union1d(np.repeat(rows, n) * self.codewords + by_score[place], best[i])
                found[i].append(ids + r * self.codewords**2)
        return [(np.concatenate(x) + (self.size << 40)).astype(np.int64) for x in found]


def _decode(share: float, rotations: int, lists: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Caps] = {}
        step = max(16, min(1024, int((1 << 20) / np.sqrt(lists / share / rotations))))  # rows whose scores are held
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                vectors = [np.asarray(x, dtype=np.float64) for x in part.column(1).to_pylist()]
                filters: list = [None] * len(vectors)
                for size in {len(v) for v in vectors}:
                    if size not in made:
                        made[size] = Caps(size, share, rotations, lists)
                    at = [i for i, v in enumerate(vectors) if len(v) == size]
                    for i, found in zip(at, made[size].decode(_unit(np.stack([vectors[i] for i in at]))), strict=True):
                        filters[i] = found
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(filters, pa.list_(pa.int64()))],
                    names=["node", "vector", "weight", "filters"],
                )

    return run


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _compare(threshold: float):
    """Rows of a pair of blocks -> (node, links, root): links counted here, and an edge to the group's smallest node."""

    def block_pair(rows: dict[str, list]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        node = np.asarray(rows["node"], dtype=np.int64)
        block = np.asarray(rows["block"])
        unit = _unit(np.asarray(rows["vector"], dtype=np.float64))
        mask = unit @ unit.T >= threshold
        np.fill_diagonal(mask, False)
        if not rows["same"]:
            mask &= block[:, None] != block[None, :]
        if not mask.any():
            return None
        linked = np.flatnonzero(mask.any(1))
        mask, node = mask[np.ix_(linked, linked)], node[linked]
        weight = np.asarray(rows["weight"], dtype=np.float64)[linked]
        # filters before this one: pairs that share one of them have been counted there
        lists = [rows["filters"][i] for i in linked.tolist()]
        earlier = [x[x < rows["filter"]] for x in lists]
        ids, where = np.unique(np.concatenate(earlier), return_inverse=True)
        member = np.zeros((len(linked), len(ids)), dtype=np.float32)
        member[np.repeat(np.arange(len(linked)), [len(x) for x in earlier]), where] = 1
        member = member[:, member.sum(0) > 1]
        new = mask & ~(member @ member.T > 0)
        links = (new * weight[None, :]).sum(1).astype(np.int64)
        root = node.copy()
        while True:
            lower = np.minimum(root, np.where(mask, root[None, :], np.iinfo(np.int64).max).min(1))
            if (lower == root).all():
                return node, links, root
            root = lower

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, None, []

        def finish() -> None:
            if rows is not None and len(rows["node"]) > 1:
                found = block_pair(rows)
                if found is not None:
                    out.append(found)

        def table() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "links", "root"])

        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            keys = list(zip(*[columns[n].to_pylist() for n in ("filter", "low", "high")], strict=True))
            node, block, weight = (columns[n].to_pylist() for n in ("node", "block", "weight"))
            for i, k in enumerate(keys):
                if k != key:
                    finish()
                    key = k
                    rows = {"filter": k[0], "same": k[1] == k[2], "node": [], "block": [], "vector": [], "weight": [], "filters": []}
                rows["node"].append(node[i])
                rows["block"].append(block[i])
                rows["weight"].append(weight[i])
                rows["vector"].append(columns["vector"][i].values.to_numpy(zero_copy_only=False))
                rows["filters"].append(columns["filters"][i].values.to_numpy(zero_copy_only=False))
            if len(out) > 500:
                yield table()
        finish()
        yield table()

    return run


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    lists: int = LISTS,
    members: int = MEMBERS,
    rotations: int = ROTATIONS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    sound = F.coalesce(
        F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
        & F.exists("vector", lambda x: x != 0),
        F.lit(False),
    )
    valid = rows.where(sound & F.col("vec_id").isNotNull())
    nodes = valid.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    share = cap_share(valid.count(), members)
    vector = rows.schema["vector"].dataType.simpleString()
    listed = saved(
        nodes.select("node", "vector", "weight").mapInArrow(
            _decode(share, rotations, lists), f"node long, vector {vector}, weight long, filters array<long>"
        )
    )
    members = listed.select("node", F.explode("filters").alias("filter"))
    sizes = members.groupBy("filter").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    places = (
        members.join(sizes, "filter")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node", "filter"), F.col("blocks")))
        .select("node", "filter", "block", other.alias("other"))
        .select("node", "filter", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    key = ["filter", "low", "high"]
    dealt = places.join(listed, "node").repartition(*key).sortWithinPartitions(*key)
    compared = saved(
        dealt.select(*key, "block", "node", "vector", "weight", "filters").mapInArrow(
            _compare(threshold), "node long, links long, root long"
        )
    )
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    edges = compared.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    copies = valid.join(nodes.where("weight > 1"), "vector").where("vec_id <> node").select(
        F.col("vec_id").alias("a"), F.col("node").alias("b")
    )
    components = connected_components(edges.unionByName(copies)).select(
        F.col("node").alias("vec_id"), F.col("component").alias("component_id")
    )
    counted = (
        valid.join(nodes, "vector")
        .join(links, "node", "left")
        .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    alone = rows.where(~(sound & F.col("vec_id").isNotNull())).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    found = counted.unionByName(alone).join(components, "vec_id", "left")
    return found.select(
        "vec_id", "n_links", F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
