"""Near-dedup of vectors against all pairs; recall of the filters at the threshold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import spherical_caps as S

TYPES = "vec_id long, embedding array<float>, node long"


def pairs_at(cosine, n, size, rng):
    x = S._unit(rng.normal(size=(n, size)))
    z = rng.normal(size=(n, size))
    z = S._unit(z - (z * x).sum(1, keepdims=True) * x)
    return x, cosine * x + np.sqrt(1 - cosine**2) * z


@pytest.mark.parametrize("size", [64, 96, 33])
@pytest.mark.parametrize("vectors", [500, 50_000, 1_000_000])
def test_recall_at_the_threshold(size, vectors):
    caps = S.Caps(size, S.cap_share(vectors))
    x, y = pairs_at(0.95, 1000, size, np.random.default_rng(size))
    lists = caps.decode(x)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(lists, caps.decode(y), strict=True)]
    assert np.mean(met) >= 0.998
    # lists keep their length, whatever the number of vectors
    assert S.LISTS / 2 <= np.mean([len(a) for a in lists]) <= S.LISTS * 3 / 2


def test_decode_finds_every_cap_that_a_vector_exceeds():
    caps = S.Caps(33, S.cap_share(2000))
    unit = S._unit(np.random.default_rng(1).normal(size=(20, 33)))
    for v, found in zip(unit, caps.decode(unit), strict=True):
        want = set()
        for r, (turn, code) in enumerate(zip(caps.turns, caps.codes, strict=True)):
            turned = np.pad(v, (0, 1)) @ turn
            scores = (code[0] @ turned[:17])[:, None] + (code[1] @ turned[17:])[None, :]
            flat = scores.ravel()
            want |= {r * caps.codewords**2 + int(i) for i in np.flatnonzero(flat >= caps.least * np.sqrt(2))}
            want.add(r * caps.codewords**2 + int(flat.argmax()))
        assert sorted(want) == (found - (33 << 40)).tolist()


@pytest.mark.parametrize("share", [0.0001, 0.01, 0.05])
def test_cap_holds_its_share(share):
    unit = S._unit(np.random.default_rng(2).normal(size=(200_000, 24)))
    assert (unit[:, 0] >= S.cap_cosine(24, share)).mean() == pytest.approx(share, rel=0.4 if share < 0.001 else 0.05)


def test_recall_of_the_operator(spark):
    """Pairs planted at the threshold, a little above to be safe from rounding, found through the operator."""
    x, y = pairs_at(0.9501, 1500, 64, np.random.default_rng(9))
    data = [(2 * i + side, v[i].tolist(), 0) for i in range(1500) for side, v in enumerate((x, y))]
    got = S.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, node long").repartition(8))
    pairs = got.where("n_links = 1 and component_id = vec_id - vec_id % 2").count()
    assert pairs >= 0.998 * 3000


def rows():
    rng = np.random.default_rng(7)
    base = S._unit(rng.normal(size=(150, 32))).astype(np.float32)
    out = [(i, v.tolist()) for i, v in enumerate(base)]
    out += [(500 + i, (base[i % 5] * 3 + rng.normal(size=32).astype(np.float32) * 0.02).tolist()) for i in range(60)]
    out += [(900 + i, base[9].tolist()) for i in range(30)]
    out += [(940, (base[9] * 2).tolist()), (9, base[9].tolist()), (None, base[9].tolist())]
    out += [(950, None), (951, []), (952, [0.0] * 32), (953, [None] + [1.0] * 31), (954, [float("nan")] * 32),
            (955, [float("inf")] + [1.0] * 31), (956, [1.0]), (957, [2.0]), (958, base[9].tolist()[:16])]
    chain, v = base[20].astype(float), []
    for i in range(6):  # a path: neighbours link, ends do not
        chain = chain + 0.28 * S._unit(rng.normal(size=(1, 32)))[0]
        v.append((20 if i == 0 else 960 + i, chain.astype(np.float32).tolist()))
    return out + v[1:]


def plain(data):
    good = [(i, np.asarray(v, dtype=np.float64)) for i, v in data
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, root = {}, {i: i for i, _ in data if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, x) in enumerate(good):
        links.setdefault((i, k), 0)
        for m, (j, y) in enumerate(good[:k]):
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= S.THRESHOLD:
                links[i, k] += 1
                links[j, m] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return links, {i: find(i) for i in root}


@pytest.mark.parametrize("block", [S.BLOCK, 7])
def test_links_and_components_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    data = rows()
    got = S.near_duplicates(spark.createDataFrame([(*r, 1) for r in data], TYPES).repartition(4)).collect()
    assert len(got) == len(data)
    links, component = plain(data)
    assert sorted((r.vec_id, r.n_links) for r in got if (r.vec_id, r.n_links) != (None, 0) and r.n_links) == sorted(
        (i, n) for (i, _), n in links.items() if n
    )
    for r in got:
        if r.vec_id is not None:
            assert r.component_id == component[r.vec_id] and r.kept == (r.vec_id == r.component_id)


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], TYPES)).count() == 0


def test_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = S.near_duplicates(vectors)
    assert got.select("vec_id").distinct().count() == vectors.count()
    assert got.agg(F.max("n_links")).first()[0] >= 0
