"""PPM language ID against a byte-by-byte version, held-out accuracy and edge cases."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelspark.llm.language_id import ORDER, START, _texts, code_lengths, identify, in_training, train

TRAIN = [
    ("en", "the thing and the other thing. Of the end"), ("en", "that is it and then\nthe rest"),
    ("fr", "le étant du pré et la ère"), ("fr", "la ou là\nque le"), ("xx", "12 34 56 the"),
]
TEXTS = ["the other", "là que été", "", "zzz 日本 the", "a", "\n\n", "34 12 the la"]


def brute(text, lang):
    counts = defaultdict(Counter)
    for name, t in TRAIN:
        if name != lang:
            continue
        b = bytes([START] * ORDER) + t.encode()
        for i in range(ORDER, len(b)):
            for k in range(ORDER + 1):
                counts[b[i - k : i]][b[i]] += 1
    b, nats = bytes([START] * ORDER) + text.encode(), 0.0
    for i in range(ORDER, len(b)):
        for k in range(ORDER, -1, -1):
            seen = counts.get(b[i - k : i])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if b[i] in seen:
                nats -= math.log(seen[b[i]] / total)
                break
            nats -= math.log(len(seen) / total)
        else:
            nats += math.log(256)
    return nats


@pytest.fixture(scope="module")
def trees(spark):
    rows = [(i, lang, t) for i, (lang, t) in enumerate(TRAIN)] + [(90, None, "zz"), (91, "en", None), (92, "fr", "")]
    return train(spark.createDataFrame(rows, "doc_id long, lang string, text string"), F.lit(True))


def test_code_lengths_are_those_of_the_trees(trees):
    got = code_lengths(trees, *_texts(pa.array(TEXTS)))
    assert trees.languages == ["en", "fr", "xx"]
    want = [[brute(t, lang) for lang in trees.languages] for t in TEXTS]
    assert np.allclose(got, want, rtol=1e-5)


def test_windows_do_not_change_the_result(trees, monkeypatch):
    whole = code_lengths(trees, *_texts(pa.array(TEXTS)))
    monkeypatch.setattr("panelspark.llm.language_id.WINDOW", 7)
    assert np.allclose(code_lengths(trees, *_texts(pa.array(TEXTS))), whole)


def test_edge_cases(spark, trees):
    rows = [(1, None, "a"), (1, "", "b"), (2, "123 !!", None), (None, "the thing", "c"), (3, "the thing" * 5000, "d"),
            (3, "the thing" * 5000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(2)
    got = {(r.doc.doc_id, r.doc.score): (r.lang_pred, r.score) for r in identify(docs, trees).collect()}
    assert got[1, "a"] == got[1, "b"] == got[2, None] == ("und", 0.0)
    assert got[None, "c"][0] == got[3, "d"][0] == "en"
    assert identify(docs, trees).count() == 6
    assert identify(docs.limit(0), trees).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, None, "abc")], "doc_id long, lang string, text string")
    [row] = identify(docs, train(docs, in_training())).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)


def test_held_out_accuracy(spark):
    from panelspark.llm.catalog import op4_language_id

    root = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "lang")
    got = op4_language_id(spark, root).join(truth, "doc_id").where("held_out and lang is not null")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.97
    assert op4_language_id(spark, root).where("score < 0 or score > 1").count() == 0
