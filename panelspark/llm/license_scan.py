"""License scans: notice phrases, identifier tags and license expressions.

Texts are lower-cased (A-Z) and read as words of letters, digits and non-ASCII
characters. One Aho-Corasick automaton over " word word ... " finds all notice
phrases and the names of identifier tags in one pass. The expression behind a tag
(``SPDX-License-Identifier: (MIT OR Apache-2.0) AND CC-BY-4.0``) is read by a
shunting-yard parser into postfix order, where WITH binds before AND and AND before
OR, and evaluated: a label for every license that is named (``other`` for names that
are not in the list), and a reuse rating. A
choice (OR) is worth its best side, a conjunction (AND) its worst, and an exception
(WITH) lifts a license to that of a library at least.

``score`` is the lowest rating among all notices and expressions of a text,
as all of them apply: 1 for permissive licenses, 0 if nothing was found.

An expression ends at the first token that cannot continue it; operators without
a right side and open parentheses are then closed, and one without any
license counts as not found.

Texts are read in windows of ``WINDOW`` bytes, the automaton going on from one to
the next, so a task holds a batch of texts and one window's copy, however long a
text is; each row is scanned on its own, so no key can be hot.

Defined results: a null text is an empty one; without words or places n_words
and n_base are 0, first_word and last_word null, both lists of labels empty and the
score 0; places of repeated phrases all count, and rows that repeat get a result
each; an empty table gives an empty result; extra columns are kept in one struct,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a text that are normalised at once.
WINDOW = 1 << 20

# Phrases of the base labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "under the bsd license": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "cc0 1 0 universal": "cc0",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved": "proprietary",
}

# Names of identifier tags, as they are written.
TAGS = ("spdx-license-identifier", "license-expression")

# How far a license allows reuse.
RATINGS = {
    "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 1.0, "isc": 1.0, "zlib": 1.0, "bsd": 1.0, "apache-2": 1.0,
    "cc-by": 0.9, "mpl": 0.7, "lgpl": 0.7, "epl": 0.7, "cc-by-sa": 0.5, "gpl": 0.4, "gpl-2": 0.4, "gpl-3": 0.4,
    "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.1, "proprietary": 0.0,
    "other": 0.2,
}
#: Label of an identifier that is not in the list, and the least rating of a license with an exception.
OTHER, EXCEPTION_RATING = "other", 0.7

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9.+:\-]+)")

# Upper case to lower case, bytes of no word to spaces; bytes of non-ASCII characters are parts of words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_RUNS = re.compile(b" {2,}")


def label_of(identifier: str) -> str:
    """The label of a license identifier: versions that the label does not tell apart go."""
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier)
    name = re.sub(r"(\.0)+$", "", name)
    if name in RATINGS:
        return name
    family = re.sub(r"-[0-9.]+(-clause|-international)?$", "", name)
    return family if family in RATINGS else OTHER


def expression_tokens(raw: bytes, start: int) -> Iterator[str]:
    while found := _TOKEN.match(raw, start):
        yield found[1].decode()
        start = found.end()


def to_postfix(tokens: Iterable[str]) -> list[str]:
    """Shunting-yard: the longest expression at the head of ``tokens``, in postfix order."""
    out: list[str] = []
    waiting: list[str] = []
    depth, after_operand = 0, False
    for token in tokens:
        if not after_operand:
            if token == "(":
                waiting.append(token)
                depth += 1
            elif token in _PRECEDENCE or token == ")":
                break
            else:
                out.append(token)
                after_operand = True
        elif token in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            after_operand = False
        elif token == ")" and depth:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            depth -= 1
        else:
            break
    if out and not after_operand:  # the last operator has no right side
        while waiting.pop() == "(":
            pass
    return out + [t for t in reversed(waiting) if t != "("] if out else []


def evaluate(postfix: Sequence[str]) -> tuple[set[str], float] | None:
    """(labels, rating) of an expression in postfix order, None for an empty one."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token in _PRECEDENCE and len(stack) > 1:
            (more, b), (labels, a) = stack.pop(), stack.pop()
            if token == "with":  # the exception is no license
                stack.append((labels, max(a, EXCEPTION_RATING)))
            else:
                stack.append((labels | more, max(a, b) if token == "or" else min(a, b)))
        elif token not in _PRECEDENCE:
            label = label_of(token)
            stack.append(({label}, RATINGS[label]))
    return stack[-1] if stack else None


def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for phrase in {**NOTICE_PHRASES, **BASE_PHRASES}:
        made.add_word(f" {phrase} ", phrase)
    for tag in TAGS:
        made.add_word(f" {tag.replace('-', ' ')} ", tag)
    made.make_automaton()
    return made


class Scanner:
    """Scans texts, given as UTF-8 bytes."""

    def __init__(self):
        self.automaton = _automaton()
        self.lengths = {phrase: phrase.count(" ") + 1 for phrase in BASE_PHRASES}
        self.tag = re.compile(b"(?:" + b"|".join(t.encode() for t in TAGS) + rb")[ \t]*[:=]")

    def places(self, raw: bytes) -> Iterator[tuple[int, str]]:
        """(words up to the end, phrase) of each match, and at last (all words, "")."""
        search = self.automaton.iter(" ")
        list(search)  # all texts begin behind a space
        words, read, between = 0, 1, True
        for start in range(0, len(raw) + 1, WINDOW):
            window = raw[start : start + WINDOW].translate(_WORDS)
            if start + WINDOW > len(raw):
                window += b" "
            window = _RUNS.sub(b" ", window)
            if between:
                window = window.removeprefix(b" ")
            if not window:
                continue
            between = window.endswith(b" ")
            search.set(window.decode("latin-1"), False)
            counted = 0
            for end, phrase in search:
                words += window.count(b" ", counted, end - read + 1)
                counted = end - read + 1
                yield words, phrase
            words += window.count(b" ", counted)
            read += len(window)
        yield words, ""

    def expressions(self, raw: bytes) -> Iterator[tuple[set[str], float]]:
        """(labels, rating) of the expression behind each identifier tag."""
        lowered = raw.lower()  # of bytes: only A-Z change
        for tag in self.tag.finditer(lowered):
            found = evaluate(to_postfix(expression_tokens(lowered, tag.end())))
            if found:
                yield found

    def scan(self, raw: bytes) -> tuple:
        n_base, first, last, base, phrases = 0, None, None, set(), set()
        n_words = 0
        for n_words, phrase in self.places(raw):
            if phrase in BASE_PHRASES:
                last = n_words - self.lengths[phrase]
                first = last if first is None else first
                first, last = min(first, last), max(last, first)
                n_base += 1
                base.add(BASE_PHRASES[phrase])
            elif phrase:
                phrases.add(phrase)
        notices = {NOTICE_PHRASES[p] for p in phrases if p in NOTICE_PHRASES}
        if notices & {"gpl-2", "gpl-3"}:
            notices.discard("gpl")
        notices |= base
        ratings = [RATINGS[label] for label in notices]
        if phrases & set(TAGS):
            for labels, rating in self.expressions(raw):
                notices |= labels
                ratings.append(rating)
        return (
            n_words, n_base, first, last, ",".join(sorted(base)), ",".join(sorted(notices)), min(ratings, default=0.0)
        )


_FIELDS = (
    ("n_words", "long", pa.int64()), ("n_base", "long", pa.int64()), ("first_word", "long", pa.int64()),
    ("last_word", "long", pa.int64()), ("base_labels", "string", pa.string()), ("labels", "string", pa.string()),
    ("score", "double", pa.float64()),
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    names = ["doc", *[name for name, _, _ in _FIELDS]]
    for batch in batches:
        texts = batch.column(1)
        rows = [scanner.scan(texts[i].as_py() or b"") for i in range(batch.num_rows)]
        columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, (_, _, t) in zip(columns, _FIELDS, strict=True)]], names=names
        )


def scan_licenses(docs: DataFrame, *, keep: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """(doc struct, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    ``keep`` names the columns of ``docs`` that go through (all by default)."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("doc"),
        F.col(f"`{text_col}`").cast("binary").alias("body"),
    )
    kinds = ", ".join(f"{name} {kind}" for name, kind, _ in _FIELDS)
    return rows.mapInArrow(_scan, f"doc {rows.schema['doc'].dataType.simpleString()}, {kinds}")
