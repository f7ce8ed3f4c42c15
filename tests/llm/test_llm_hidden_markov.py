"""The hidden Markov model against sums over all paths, counts against plain ones, held-out gain, edge cases."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import hidden_markov as H

CHAIN = H.Chain(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]),
                np.array([[0.5, 0.1], [0.3, 0.3], [0.2, 0.6]]))
SEQUENCES = [np.array(s, "<u2") for s in ([0, 1, 2, 2], [1], [2, 0], [0, 0, 1, 2, 1], [1, 1, 1])]


def paths(sequence, chain=CHAIN):
    for path in itertools.product(range(2), repeat=len(sequence)):
        p = chain.first[path[0]] * chain.emit[sequence[0], path[0]]
        for a, b, x in zip(path, path[1:], sequence[1:], strict=False):
            p *= chain.move[a, b] * chain.emit[x, b]
        yield path, p


def test_forward_is_the_sum_over_paths():
    want = [math.log(sum(p for _, p in paths(s))) for s in SEQUENCES]
    assert np.allclose(H.forward(CHAIN, SEQUENCES), want)


def test_expected_counts_are_those_of_the_paths():
    first, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for s in SEQUENCES:
        total = sum(p for _, p in paths(s))
        for path, p in paths(s):
            first[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p / total
            for x, k in zip(s, path, strict=True):
                emit[x, k] += p / total
    like, f, m, e = H.expected_counts(CHAIN, SEQUENCES, np.ones(5, dtype=bool), CHAIN.stationary())
    assert np.allclose(f, first, rtol=1e-4) and np.allclose(m, move, rtol=1e-4) and np.allclose(e, emit, rtol=1e-4)
    assert np.isclose(like, H.forward(CHAIN, SEQUENCES).sum(), rtol=1e-5)


def plain_base(rows):
    counts = Counter(t for _, text, train in rows if train for t in H.tokens(text or ""))
    n, v = sum(counts.values()), len(counts)
    score = lambda text: sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in H.tokens(text or ""))
    return n, [(i, len(H.tokens(t or "")), sum(counts[x] > 0 for x in H.tokens(t or "")), score(t)) for i, t, _ in rows]


ROWS = [(1, "The cat\tsat on THE mat", True), (2, "the dog sat", True), (3, None, True), (3, "", False), (4, "zebra É été", False),
        (None, "the cat", True), (5, "long text of many words " * 3000, False), (6, "the dog sat", True), (6, "the dog sat", True)]


@pytest.mark.parametrize(("top", "types"), [(H.TOP, H.CHUNK_TYPES), (3, 4)])
def test_base_scores_and_counts(spark, monkeypatch, top, types):
    monkeypatch.setattr(H, "TOP", top)
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, train boolean, score string").repartition(3)
    got = H.score_documents(docs, F.col("train"), keep=["doc_id", "score"], passes=1).collect()
    n, want = plain_base(ROWS)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    assert len(got) == len(ROWS) and {r.train_tokens for r in got} == {n}
    for g, w in zip(sorted(((r.doc.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got), key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and math.isclose(g[3], w[3], rel_tol=1e-9)


def test_nothing_to_learn_from_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    [row] = H.score_documents(docs, F.lit(False), passes=1).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)
    assert H.score_documents(docs.limit(0), F.lit(True), passes=1).count() == 0


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    args = (F.col("doc_id") % 5 != 0,)
    whole = {r.doc.doc_id: (r.n_known, r.base_score, r.score) for r in H.score_documents(docs, *args, passes=1).collect()}
    monkeypatch.setattr(H, "CHUNK_CHARS", 2000)
    parts = {r.doc.doc_id: (r.n_known, r.base_score, r.score) for r in H.score_documents(docs, *args, passes=1).collect()}
    assert all(np.allclose(whole[k], parts[k]) for k in whole)


def test_held_out_texts_gain_and_training_improves(spark):
    from panelspark.llm.catalog import op2_hidden_markov

    root = "/root/testdata/sf0.01"
    out = op2_hidden_markov(spark, root).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.count("*")).first()
    assert out[2] > 50 and out[1] > out[0]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    _, words = H.count_tokens(docs, "text")
    classes = H._Classes(words.top)
    rows = [(np.array([classes[t] for t in H.tokens(r.text or "")], "<u2").tobytes(),) for r in docs.limit(100).collect()]
    _, history = H.train_chain(spark.createDataFrame(rows, "classes binary"), words, 4, 4)
    assert all(a < b for a, b in zip(history, history[1:], strict=False))
