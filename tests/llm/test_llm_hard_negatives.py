"""Hard negatives against a plain search over all pairs; bounds against the scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import hard_negatives as H

TYPES = "vec_id long, embedding array<float>, label int, angles string"
ANCHORS = "vec_id % 5 = 0"


def plain(data, anchors=lambda i: i % 5 == 0, positives=5, negatives=10):
    rows = {}
    for i, v, label, *_ in data:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = (label, [float(np.float32(c)) for c in v])
        rows[i] = min(rows.get(i, x), x)
    rows = {i: (label, [math.floor(256 * c) for c in v]) for i, (label, v) in rows.items()}
    rows = {i: r for i, r in rows.items() if sum(c * c for c in r[1]) < 2**62}
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for a, (label, x) in rows.items():
        if not anchors(a):
            continue
        found = sorted((-score(x, y), i, kind) for i, (kind, y) in rows.items() if i != a and len(x) == len(y))
        for s, p, _ in [f for f in found if f[2] == label][:positives]:
            ps = -s
            fit = [(n, -m) for m, n, kind in found if kind != label and 30 * ps <= -100 * m <= 90 * ps]
            out += [(a, p, r + 1, n, ps, m) for r, (n, m) in enumerate(fit[:negatives])]
    return sorted(out)


def rows():
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(4, 16))
    out = [(i, (centres[i % 4] + 0.7 * rng.normal(size=16)).tolist(), int(rng.integers(3))) for i in range(240)]
    out += [(300 + i, centres[1].tolist(), i % 2) for i in range(40)]  # ties
    out += [(400, [0.0] * 16, 1), (405, [0.0] * 16, 2), (410, (-centres[0]).tolist(), 0), (415, [3.0, 1.0], 1), (416, [2.0, 1.0], 1),
            (417, [1.0, 1.0], 2), (420, [1e30] * 16, 1), (421, [1e5] * 16, 1), (425, [1e5] * 16, 2)]
    out += [(500, None, 1), (505, [1.0] * 16, None), (None, [1.0] * 16, 1), (510, [], 1), (515, [None] + [1.0] * 15, 1),
            (520, [float("nan")] * 16, 1), (525, [float("-inf")] * 16, 1)]
    out += [out[0], (5, centres[2].tolist(), 0), (5, centres[2].tolist(), 2)]  # repeated ids
    return [(*r, "own") for r in out]


@pytest.mark.parametrize("block, slab, chunk", [(4096, 1 << 16, 256), (50, 9, 4)])
def test_rows_are_those_of_all_pairs(spark, monkeypatch, block, slab, chunk):
    for name, value in (("BLOCK", block), ("SLAB", slab), ("CHUNK", chunk)):
        monkeypatch.setattr(H, name, value)
    data = rows()
    got = H.mine_hard_negatives(spark.createDataFrame(data, TYPES).repartition(3), F.expr(ANCHORS)).collect()
    assert sorted(map(tuple, got)) == plain(data)


@pytest.mark.parametrize("data", [[], [(0, [1.0], 1, "x")], [(0, [1.0], 1, "x"), (1, [1.0], 2, "x")], [(0, None, None, None)]])
def test_without_pairs(spark, data):
    assert H.mine_hard_negatives(spark.createDataFrame(data, TYPES), F.expr(ANCHORS)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 16, 64])
def test_bounds_hold(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-300, 300, size=(300, size))
    x = np.concatenate([x, x[:50], 3 * x[:50], -x[:50], np.zeros((1, size), int), x[:20] + 1])
    unit = H._unit(x)
    base = H.far_apart(unit[:100], H.REFERENCES)
    angles = np.arccos(np.clip(unit @ base.T, -1, 1))
    r = H.Rows(np.arange(len(x)), np.zeros(len(x)), x, np.linalg.norm(x, axis=1), angles)
    low, high = H.score_bounds(r, r)
    true = x @ x.T
    assert (H.scores(r, r) == true).all()
    assert (low <= true).all() and (true <= high).all()


def test_filter_leaves_few_pairs_of_clustered_vectors(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 32)) * 100
    x = np.floor(centres[rng.integers(20, size=2000)] + rng.normal(size=(2000, 32)) * 4).astype(int)
    angles = np.arccos(np.clip(H._unit(x) @ H.far_apart(H._unit(x), H.REFERENCES).T, -1, 1))
    r = H.Rows(np.arange(2000), np.zeros(2000), x, np.linalg.norm(x, axis=1), angles)
    counted, real = [], H.scores
    monkeypatch.setattr(H, "scores", lambda a, b: counted.append(len(a) * len(b)) or real(a, b))
    for i in range(100):
        list(H.find_positives(5)(r.take(np.array([i])), r))
    assert sum(counted) < 100 * 2000 / 5


def test_large_scores_are_exact():
    x = np.array([[2**30 + 1, 2**30 - 1], [2**30 + 3, -(2**30) + 5]])
    r = H.Rows(np.arange(2), np.zeros(2), x, np.linalg.norm(x.astype(float), axis=1), np.zeros((2, 1)))
    assert H.scores(r, r).tolist() == [[sum(int(p) * int(q) for p, q in zip(a, b, strict=True)) for b in x] for a in x]
