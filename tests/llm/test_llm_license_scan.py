"""License scans against plain searches, and license expressions against a recursive reading."""

import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from panelspark.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    """The base columns, place by place."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = []
    for phrase, label in L.BASE_PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


PIECES = ["under the MIT License.", "under the", "mit", "license", "Apache License, Version 2.0", "apache-license", "version",
          "2", "CC BY-NC 4.0", "cc", "by", "nc", "cc by nc cc by nc", "É", "é2", "日本", "x", "\n", "  ", "--", "\x00", "\x7f", "_", "@["]


@given(st.lists(st.sampled_from(PIECES), max_size=30), st.sampled_from([" ", "", "\n"]))
def test_base_columns_are_those_of_a_plain_search(parts, joint):
    text = joint.join(parts)
    assert L.Scanner().scan(text.encode())[:5] == plain(text)


@pytest.mark.parametrize("window", [1, 2, 3, 7, 50])
def test_windows_do_not_change_the_result(monkeypatch, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choices(PIECES, k=40)) for _ in range(30)] + ["", " ", "a", "cc by nc", " \n cc by nc "]
    want = [L.Scanner().scan(t.encode()) for t in texts]
    monkeypatch.setattr(L, "WINDOW", window)
    assert [L.Scanner().scan(t.encode()) for t in texts] == want
    assert [w[:5] for w in want] == [plain(t) for t in texts]


def read(tokens):
    """A complete expression by recursion: WITH, then AND, then OR."""

    def level(kind):
        node = atom() if kind == "with" else level({"or": "and", "and": "with"}[kind])
        while tokens and tokens[0] == kind:
            tokens.pop(0)
            right = atom() if kind == "with" else level({"or": "and", "and": "with"}[kind])
            if kind == "with":
                node = (node[0], max(node[1], L.EXCEPTION_RATING))
            else:
                node = (node[0] | right[0], (max if kind == "or" else min)(node[1], right[1]))
        return node

    def atom():
        token = tokens.pop(0)
        if token == "(":
            node = level("or")
            tokens.pop(0)
            return node
        label = L.label_of(token)
        return {label}, L.RATINGS[label]

    return level("or")


NAMES = st.sampled_from(["mit", "gpl-3.0-only", "apache-2.0", "cc-by-nc-4.0", "bsd-3-clause", "licenseref-own"])
EXPRESSIONS = st.recursive(
    NAMES.map(lambda n: [n]),
    lambda inner: st.one_of(
        st.tuples(inner, st.sampled_from(["and", "or"]), inner).map(lambda t: [*t[0], t[1], *t[2]]),
        inner.map(lambda t: ["(", *t, ")"]),
        NAMES.map(lambda n: [n, "with", "classpath-exception-2.0"]),
    ),
    max_leaves=12,
)


@given(EXPRESSIONS)
def test_expressions_are_read_as_by_recursion(tokens):
    assert L.evaluate(L.to_postfix(tokens)) == read(list(tokens))


@pytest.mark.parametrize("text, labels, rating", [
    ("MIT", {"mit"}, 1.0), ("(MIT OR GPL-2.0-only) AND CC-BY-4.0", {"mit", "gpl-2", "cc-by"}, 0.9),
    ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl-2"}, 0.7), ("MIT OR", {"mit"}, 1.0), ("(MIT AND (", {"mit"}, 1.0),
    ("MIT) AND GPL-3.0", {"mit"}, 1.0), ("MIT and then some", {"mit", "other"}, 0.2), ("AND MIT", None, None), ("((", None, None),
    ("", None, None), ("MIT\nOR GPL-3.0", {"mit"}, 1.0), ("GPL-3.0-or-later", {"gpl-3"}, 0.4), ("BSD-3-Clause", {"bsd"}, 1.0),
    ("CC-BY-NC-SA-4.0 OR ISC", {"cc-by-nc-sa", "isc"}, 1.0),
])
def test_expressions_behind_tags(text, labels, rating):
    got = L.evaluate(L.to_postfix(L.expression_tokens(text.lower().encode(), 0)))
    assert got == (None if labels is None else (labels, rating))


def test_table(spark):
    long = "word " * 400_000 + "Licensed under CC BY-NC 4.0. " + "é " * 200_000 + "under the MIT License"
    deep = "# SPDX-License-Identifier: " + "(" * 50_000 + "MIT" + ")" * 50_000 + " AND GPL-3.0-only\n"
    data = [(1, None), (2, ""), (3, "Released under the MIT License."), (3, "Released under the MIT License."), (None, "cc by nc"),
            (4, long), (5, deep), (6, "GNU General Public License, version 3, or the GNU General Public License"),
            (7, "SPDX-License-Identifier: Apache-2.0 OR MIT"), (8, "spdx license identifier, as we say"), (9, "a clean text")]
    docs = spark.createDataFrame([(i, t, "own", 0.5) for i, t in data], "doc_id long, text string, labels string, score double")
    got = L.scan_licenses(docs).collect()
    assert len(got) == len(data)
    found = {r.doc.doc_id: r for r in got}
    for i, t in data:
        assert tuple(found[i][1:6]) == plain(t)
        assert found[i].doc.labels == "own" and 0 <= found[i].score <= 1
    assert [found[i].labels for i in range(1, 10)] == [
        "", "", "mit", "cc-by-nc,mit", "gpl-3,mit", "gpl-3", "apache-2,mit", "", ""
    ]
    assert [found[i].score for i in range(1, 10)] == [0, 0, 1.0, 0.1, 0.4, 0.4, 1.0, 0, 0]
    assert L.scan_licenses(docs.limit(0), keep=["doc_id"]).count() == 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc.doc_id: tuple(r[1:6]) for r in L.scan_licenses(docs, keep=["doc_id"]).collect()}
    assert got == {r.doc_id: plain(r.text) for r in docs.collect()}
    assert sum(n[1] for n in got.values()) > 20
