"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of variable order, from the longest
(``order`` bytes) down to none. A byte seen in a context costs the log of its
share of the context's counts plus its number of distinct bytes; a byte not
seen costs the escape of that context and then what it costs in the context one
byte shorter, down to a uniform code over 256 bytes (escape method C, without
exclusions). The statistics are frozen after training, so the cost of a text is
an exact code length in each language, and the shortest one wins.

Training is the only part that is bounded: of the labelled training rows, the
``train_docs`` rows of each language with the smallest md5 of the id (whole
texts, and ties of the last one). The byte counts are aggregated over the
cluster; the trees of all languages are joined into tables that are sent to the
executors: their size depends on the sample and the number of languages, not on
the corpus. Every text is then scored whole, in windows of bounded size.

Defined results: a text that is null or has no letter is `und` with score 0,
as is every text where nothing could be learned; equal code lengths go to the
smaller language name; rows with null language, null or empty text teach
nothing; extra columns are kept in one struct.

The score is the posterior probability of the predicted language among those
learned, with equal priors. Rows that repeat get a result each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import crc32_mod

ORDER = 3
TRAIN_DOCS = 300
UNKNOWN = "und"
#: Bytes scored at a time.
WINDOW = 1 << 18
#: What stands before the first byte of a text.
START = 10


@dataclass
class Trees:
    """Joined context trees: ``symbol`` maps a byte to its class (0: never seen).

    ``step[k][id, symbol]`` is the id of the context that ``symbol`` makes of a
    context of k bytes (0: not in any tree); ``cost[k][id, symbol]`` the code
    length in nats of ``symbol`` after the context ``id`` of k bytes, for every
    language, escapes included.
    """

    languages: list[str]
    symbol: np.ndarray
    step: list[np.ndarray]
    cost: list[np.ndarray]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of strings and the len + 1 offsets of its rows."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def _padded(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after another, each behind ``order`` start bytes; the row
    of every byte; whether it belongs to the text."""
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes + order)
    starts = np.cumsum(np.concatenate([[0], sizes[:-1] + order]))
    own = np.arange(len(row)) - starts[row] >= order
    out = np.full(len(row), START, dtype=np.uint8)
    out[own] = data[offsets[0] : offsets[-1]]
    return out, row, own


def _grams(order: int):
    """Counts of byte strings up to order + 1 long; a string is a number with a leading 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, name in enumerate(names):
                data, offsets = _texts(batch.column(1).slice(i, 1))
                padded, _, own = _padded(data, offsets, order)
                wide = padded.astype(np.int64)
                key = np.ones(len(wide), dtype=np.int64)
                for length in range(1, order + 2):
                    # the byte at ``length - 1`` places before, the current one last
                    back = length - 1
                    shifted = np.concatenate([np.full(min(back, len(wide)), START), wide[: len(wide) - back]])
                    key = key + (shifted << (8 * back)) + ((1 << (8 * length)) - (1 << (8 * back)))
                    values, counts = np.unique(key[own], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(values), pa.string()), pa.array(values), pa.array(counts)],
                        names=["lang", "gram", "n"],
                    )

    return run


def train(
    docs: DataFrame,
    training: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    train_docs: int = TRAIN_DOCS,
) -> Trees:
    """Trees of all languages that the rows with ``training`` name."""
    rows = docs.where(training & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("mark"),
        F.col(text_col).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    limits = (
        rows.select("lang", "mark").withColumn("place", place).where(F.col("place") <= train_docs)
        .groupBy("lang").agg(F.max("mark").alias("limit"))
    )  # one row per language
    sample = rows.join(F.broadcast(limits), "lang").where("mark <= limit and length(text) > 0")
    counts = (
        sample.select("lang", "text").mapInArrow(_grams(order), "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    found = counts.toArrow()
    return build_trees(
        np.asarray(found.column("lang").to_pylist(), dtype=object),
        found.column("gram").to_numpy(),
        found.column("n").to_numpy(),
        order,
    )


def build_trees(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int) -> Trees:
    languages = sorted(set(lang.tolist()))
    which = {x: i for i, x in enumerate(languages)}
    column = np.asarray([which[x] for x in lang.tolist()], dtype=np.int64)
    seen = np.unique(gram[(gram >= 1 << 8) & (gram < 1 << 16)] & 255)
    symbol = np.zeros(256, dtype=np.int32)
    symbol[np.union1d(seen, [START])] = np.arange(1, len(np.union1d(seen, [START])) + 1)
    width, count = int(symbol.max()) + 1, len(languages)
    step: list[np.ndarray] = []
    cost: list[np.ndarray] = []
    # every context of k bytes, with the prefixes and suffixes of the longer ones
    contexts = [np.zeros(0, dtype=np.int64)] * (order + 2)
    for k in range(order, -1, -1):
        mine = (gram >= 1 << (8 * (k + 1))) & (gram < 1 << (8 * (k + 2)))
        longer = contexts[k + 1]
        contexts[k] = np.unique(np.concatenate([gram[mine] >> 8, longer >> 8, _suffix(longer, k)]))
    # ids count from 1, as 0 is no context; but the empty context has the id 0
    first = [0] + [1] * (order + 1)
    shorter = np.full((1, width, count), np.log(256.0))
    for k in range(order + 1):
        mine = (gram >= 1 << (8 * (k + 1))) & (gram < 1 << (8 * (k + 2)))
        size = max(1, len(contexts[k]) + first[k])
        counts = np.zeros((size, width, count))
        np.add.at(
            counts,
            (np.searchsorted(contexts[k], gram[mine] >> 8) + first[k], symbol[gram[mine] & 255], column[mine]),
            n[mine],
        )
        total, kinds = counts.sum(1), (counts > 0).sum(1)
        if k:
            suffix = np.searchsorted(contexts[k - 1], _suffix(contexts[k], k - 1)) + first[k - 1]
            shorter = shorter[np.concatenate([[0], suffix])]
        with np.errstate(divide="ignore", invalid="ignore"):
            all_of = np.log(total + kinds)[:, None, :]
            escape = np.where(total > 0, np.log(total + kinds) - np.log(kinds), 0.0)[:, None, :]
            shorter = np.where(counts > 0, all_of - np.log(counts), escape + shorter)
        cost.append(shorter.astype(np.float32))
        if k < order:
            longer = contexts[k + 1]
            table = np.zeros((size, width), dtype=np.int32)
            own = np.searchsorted(contexts[k], longer >> 8) + first[k]
            table[own, symbol[longer & 255]] = np.arange(len(longer)) + 1
            step.append(table)
    return Trees(languages, symbol, step, cost)


def _suffix(contexts: np.ndarray, length: int) -> np.ndarray:
    """The last ``length`` bytes of each context, as a number with a leading 1."""
    return contexts & ((1 << (8 * length)) - 1) | (1 << (8 * length))


def code_lengths(trees: Trees, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Nats of each row's text in each language."""
    order = len(trees.step)
    padded, row, own = _padded(data, offsets, order)
    symbols = trees.symbol[padded]
    total = np.zeros((len(offsets) - 1, len(trees.languages)))
    for start in range(0, len(symbols), WINDOW):
        at = np.arange(start, min(start + WINDOW, len(symbols)))
        at = at[own[at]]
        rows = row[at]
        for k in range(order, -1, -1):
            ids = np.zeros(len(at), dtype=np.int64)
            for j in range(k):
                # id 0 is the empty context at the first step only; after it, row 0 of a table
                # is empty, so a broken path stays at 0
                ids = trees.step[j][ids, symbols[at - k + j]]
            known = ids > 0 if k else np.ones(len(at), dtype=bool)
            nats = trees.cost[k][ids[known], symbols[at[known]]]
            for i in range(len(trees.languages)):
                total[:, i] += np.bincount(rows[known], weights=nats[:, i], minlength=len(total))
            at, rows = at[~known], rows[~known]
            if not len(at):
                break
    return total


def _predict(model, text_at: int | None):
    """``text_at``: place of the text among the kept columns, None if it comes as a column of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: Trees = model.value
        for batch in batches:
            letters = batch.column(1)
            column = batch.column(2) if text_at is None else batch.column(0).field(text_at)
            sizes = np.diff(_texts(column)[1])
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(WINDOW, sizes.sum() + WINDOW, WINDOW)) + 1
            edges = sorted({0, len(sizes), *np.minimum(cuts, len(sizes)).tolist()})
            for a, b in zip(edges, edges[1:], strict=False):
                known = np.asarray(letters.slice(a, b - a).to_pylist(), dtype=bool)
                best, score = np.zeros(b - a, dtype=int), np.zeros(b - a)
                if trees.languages:
                    nats = code_lengths(trees, *_texts(column.slice(a, b - a)))
                    best = nats.argmin(1)
                    score = 1 / np.exp(nats.min(1)[:, None] - nats).sum(1)
                    found = [trees.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
                else:
                    found = [UNKNOWN] * (b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found, pa.string()), pa.array(np.where(known, score, 0.0))],
                    names=["doc", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, trees: Trees, *, keep: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """(doc struct, lang_pred, score) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(trees)
    kept = list(keep or docs.columns)
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        *([] if text_col in kept else [text.alias("body")]),  # a text goes to Python once
    )
    text_at = kept.index(text_col) if text_col in kept else None
    return rows.mapInArrow(
        _predict(model, text_at), f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double"
    )


def in_training(id_col: str = "doc_id", folds: int = 3, held_out: int = 1) -> Column:
    """Whether a row's id puts it into the training part."""
    return crc32_mod(id_col, folds) != held_out
