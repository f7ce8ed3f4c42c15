"""Counts against a plain version, the estimate against numpy, rejection of planted junk, edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from panelspark.llm import robust_outliers as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@given(st.text(alphabet="ab \n\té#|\x1c　", max_size=120))
def test_counts(text):
    assert R.text_counts(text) == plain_counts(text)


def test_chi_square():
    assert abs(R._quantile_4(0.05) - 9.4877) < 1e-3
    assert abs(R._consistency(1 - 1e-12) - 1) < 1e-6


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    clean = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, clean(rng.randint(60, 900)), "en", "hot", 1) for i in range(300)]
    rows += [(1000 + i, " ".join(f"{word()}***" for _ in range(200)), "en", "hot", 1) for i in range(40)]
    rows += [(2000 + i, clean(100), None, None, 1) for i in range(5)]
    rows += [(3000, None, "en", "hot", 1), (3001, "", "en", "hot", 1), (3002, "short one", "en", "hot", 1),
             (3003, "a b c " * 50, "en", "hot", 1), (None, clean(80), "en", "hot", 1), (0, rows[0][1], "en", "hot", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int")
    return {(r.doc.doc_id, i): r for i, r in enumerate(R.judge(docs.repartition(4)).collect())}, rows


def test_junk_goes_and_clean_stays(judged):
    got, rows = judged
    assert len(got) == len(rows)
    for (i, _), r in got.items():
        if i is None or i < 1000 or 2000 <= i < 3000:
            assert r.kept and not r.base_failed, (i, r.distance)
        elif i < 2000:
            assert not r.kept and not r.base_failed
        else:
            assert r.base_failed and not r.kept


def test_small_groups_have_no_estimate(judged):
    assert all(r.distance is None for (i, _), r in judged[0].items() if i is not None and 2000 <= i < 3000)


def test_subset_estimate_is_robust(judged):
    """The distances of clean documents hardly feel the junk: most are well inside."""
    d = [r.distance for (i, _), r in judged[0].items() if i is not None and i < 1000]
    assert np.median(d) < R._quantile_4(0.05)


def texts(rng, n, mark=""):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) + mark for _ in range(n))


@pytest.mark.parametrize("share, copies", [(0.28, False), (0.34, True), (0.4, False), (0.4, True)])
def test_junk_up_to_two_fifths_of_a_group_goes(spark, share, copies):
    """Junk, each text its own or all copies of one, in a group that is otherwise clean."""
    rng, n = random.Random(6), 400
    junk = int(share * n)
    one = texts(rng, 200, "**")
    rows = [(i, texts(rng, 200), "en", "a") for i in range(n - junk)]
    rows += [(1000 + i, one if copies else texts(rng, 200, "**"), "en", "a") for i in range(junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc.doc_id: r for r in R.judge(docs.repartition(4)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert not [i for i, r in got.items() if i >= 1000 and r.kept]
    assert not [i for i, r in got.items() if i < 1000 and not r.kept]


def test_small_groups_are_judged_by_larger_ones(spark):
    """Junk in groups of four goes, by the language's documents or by all of them; clean texts stay."""
    rng = random.Random(7)
    rows = [(i, texts(rng, 200), "en", f"s{i // 4}") for i in range(60)] + [(60 + i, texts(rng, 200), "de", "s0") for i in range(5)]
    rows += [(100 + i, texts(rng, 200, "**"), *g) for i, g in enumerate([("en", "s0"), ("en", "s9"), ("en", None), ("de", "s0"), (None, "s0")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = R.judge(docs.repartition(4)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.distance is None and r.pooled_distance is not None and not r.base_failed
        assert r.kept == (r.doc.doc_id < 100), r


def test_repeated_lines_and_words_decide_alone(spark):
    """Documents with a third to a half of their lines, or a third of their words, repeated go; one short repeat stays."""
    rng = random.Random(9)
    prose = lambda n: [texts(rng, 10) for _ in range(n)]
    rows = [(i, "\n".join(prose(rng.randint(6, 60)))) for i in range(150)]
    rows += [(200 + i, "\n".join([*(x := prose(6)), x[0]])) for i in range(6)]
    for i in range(20):  # a word of a line of its own between the lines of prose
        lines = prose(40)
        for k in range(21 + i):
            lines.insert(2 * k, "menu")
        rows.append((1000 + i, "\n".join(lines)))
    rows += [(2000 + i, " ".join([*(x := prose(34)), *x[:7]])) for i in range(20)]
    docs = spark.createDataFrame([(*r, "en", "a") for r in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc.doc_id: r for r in R.judge(docs.repartition(4)).collect()}
    assert all(0.3 <= got[1000 + i].n_dup_lines / got[1000 + i].n_lines <= 0.5 for i in range(20))
    assert all(0.3 <= got[2000 + i].n_repeat_words / got[2000 + i].n_words <= 0.5 for i in range(20))
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {i for i in got if i >= 1000}


@pytest.mark.parametrize("empty", [None, "", " \n\t\n"])
def test_texts_without_words_among_texts_that_repeat_nothing(spark, empty):
    """The group's scatter is zero where nothing is repeated, and a text without words has no sampling variance."""
    rng = random.Random(10)
    rows = [(i, texts(rng, 200), "en", "a") for i in range(40)] + [(100 + i, empty, "en", "a") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc.doc_id: r for r in R.judge(docs.repartition(4)).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert (r.n_words, r.base_failed, r.kept) == ((0, True, False) if i >= 100 else (200, False, True))
        assert (r.distance is None) == (i >= 100) and r.pooled_distance is None


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert R.judge(docs).count() == 0
