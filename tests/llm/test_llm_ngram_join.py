"""The Jaccard join against all pairs, on planted copies and on a given table."""

import random
import re

import pytest

from panelspark.llm.ngram_join import jaccard_components, prefix_size, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(4, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_components(rows, percent=85):
    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and find(i) != find(j):
                if 100 * len(x & y) >= percent * len(x | y):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: find(i) for i in root}


def planted():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows = [(i, " ".join(text(rng.randint(1, 80)))) for i in range(100)]
    base, passage = text(200), " ".join(text(60))
    for i in range(60):  # near copies, some on either side of the threshold, and chains of them
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(200)] = rng.choice(words)
        base = copy if i % 10 == 9 else base
        rows.append((1000 - i, " ".join(copy)))
    rows += [(2000 + i, f"{passage} {' '.join(text(rng.choice([3, 8, 40])))}") for i in range(40)]
    rows += [(3000 + i, "same short") for i in range(5)] + [(3100, "SAME Short"), (3101, "short same"), (3102, "É same"), (3103, "é same")]
    rows += [(4000, None), (4001, ""), (4002, " \n"), (None, "same short"), (7, rows[7][1]), (4003, "a\x1cb c　d")]
    return rows


@pytest.mark.parametrize("rows", [planted()])
def test_components_are_those_of_all_pairs(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, token string")
    got = jaccard_components(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    want = plain_components(rows)
    for r in got:
        assert r.n_shingles == len(plain_set(r.doc.text)) or r.doc.doc_id is None
        assert r.component_id == want.get(r.doc.doc_id), r


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == plain_components([(r.doc_id, r.text) for r in docs.collect()])
    assert len(set(got.values())) < len(got)


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shingles_and_prefix():
    assert len(shingles("a b c d e a b c d")) == len(plain_set("a b c d e a b c d"))
    assert prefix_size(100, 85) == 16 and prefix_size(1, 85) == 1
