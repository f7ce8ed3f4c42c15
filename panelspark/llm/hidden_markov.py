"""LM scoring with a hidden Markov language model.

The tokens of a text are its words, ASCII lower-cased, and one end. The model is
a hidden Markov chain over word classes: the ``TOP`` most frequent tokens are a
class each, all others share ``TAIL`` classes by their last bytes. A latent state
emits a class, the class its token:

    P(text) = sum over state paths of prod P(state | last) P(class | state) P(token | class)

P(token | class) is (c + 0.1) / (C + 0.1 * (V + 1)) with the token's training
count c and the class's C tokens and V types, so one unseen token has a share in
every tail class. All of it is counted over the whole training part; the vocabulary
grows with the corpus and stays a distributed table, only the classes are sent
to the executors.

Training is Baum-Welch: every pass computes expected counts with scaled
forward and backward recursions in each task, and adds them up over the
cluster, a row per parameter. For training, long texts are cut into segments of
``SEGMENT`` tokens, which start from the chain's stationary distribution. Scores
are exact: the forward recursion runs through the whole text.

How the counts of rare tokens come to the texts without a row per word: a task
encodes its texts with a dictionary of its own, in chunks of a bounded number of
types. The chunks' dictionaries are joined with the counts, and come back to the
chunk's texts, which hold only numbers by then. Both are written as tables
first, so a chunk cannot change when an executor is lost.

Defined results: a null text is empty and has one token, the end; without
training rows counts are 0 and all words unknown; equal rows are scored alike;
an empty table gives an empty result; extra columns are kept in one struct.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored

STATES, PASSES = 8, 4
TOP, TAIL, SUFFIX = 4096, 512, 3
SMOOTH = 0.1
SEGMENT = 512
SEED = 3
#: Types of a task's counter, types of a chunk's dictionary, characters of a chunk.
COUNTED, CHUNK_TYPES, CHUNK_CHARS = 200_000, 300_000, 16 << 20
#: Tokens of texts that go through the recursions together.
GROUP = 1 << 20
#: The end of a text; no word is empty.
END = b""


def tokens(text: str) -> list[bytes]:
    words = text.encode().lower().split()  # of bytes: only A-Z change, only ASCII white space splits
    words.append(END)
    return words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[bytes] = Counter()

    def table() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["token", "n"]
        )
        found.clear()
        return out

    for batch in batches:
        for text in batch.column(0):
            found.update(tokens(text.as_py() or ""))
            if len(found) > COUNTED:
                yield table()
    yield table()


def tail_class(token: Column) -> Column:
    """Class of a token that is not among the most frequent; the same as in ``_Classes``."""
    return F.pmod(F.crc32(F.substring(token, -SUFFIX, SUFFIX)), F.lit(TAIL)).cast("int")


class _Classes(dict):
    """Class of a token: its place among the most frequent, or one of the tail."""

    def __init__(self, top: list[bytes]):
        super().__init__(zip(top, range(len(top)), strict=True))
        self.top = top

    def __missing__(self, token: bytes) -> int:
        if len(self) > CHUNK_TYPES + len(self.top):
            self.clear()
            self.update(zip(self.top, range(len(self.top)), strict=True))
        self[token] = value = len(self.top) + zlib.crc32(token[-SUFFIX:]) % TAIL
        return value


class _Places(dict):
    def __missing__(self, token: bytes) -> int:
        self[token] = value = len(self)
        return value


@dataclass
class Vocabulary:
    """What is bounded of the counts: totals, the most frequent tokens, and the tail classes' sums."""

    total: int
    types: int
    top: list[bytes]
    top_counts: np.ndarray
    tail_counts: np.ndarray
    tail_types: np.ndarray

    @property
    def class_counts(self) -> np.ndarray:
        return np.concatenate([self.top_counts, self.tail_counts]).astype(np.float64)

    @property
    def tail_scale(self) -> np.ndarray:
        """Denominator of P(token | class): 1 for a class of one token."""
        tail = self.tail_counts + SMOOTH * (self.tail_types + 1)
        return np.concatenate([np.ones(len(self.top)), tail])


def count_tokens(docs: DataFrame, text_col: str) -> tuple[DataFrame, Vocabulary]:
    """All tokens with their counts (a stored table), and the bounded part of it."""
    counts = stored(
        docs.select(text_col).mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")),
        "token-counts",
    )
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "token").limit(TOP).collect()  # at most TOP rows
    frequent = docs.sparkSession.createDataFrame([(r.token,) for r in top], "token binary")
    tail = counts.join(F.broadcast(frequent), "token", "left_anti")
    sums = tail.groupBy(tail_class(F.col("token")).alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tail_counts, tail_types = np.zeros(TAIL, dtype=np.int64), np.zeros(TAIL, dtype=np.int64)
    for r in sums:  # at most TAIL rows
        tail_counts[r.k], tail_types[r.k] = r.n, r.v
    return counts, Vocabulary(
        int(total), int(types), [bytes(r.token) for r in top], np.asarray([r.n for r in top], dtype=np.int64),
        tail_counts, tail_types,
    )


def _encode(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Vocabulary = vocabulary.value
        classes, cut = _Classes(words.top), len(words.top)
        logs = np.log10(words.top_counts + SMOOTH)
        chunk, places = TaskContext.get().partitionId() << 32, _Places()
        place, size = 0, 0
        for batch in batches:
            kind = batch.column(0).type
            texts = batch.column(batch.schema.names.index("body"))
            start, rows = 0, []

            def table(upto: int) -> pa.RecordBatch:
                part, columns = batch.slice(start, upto - start), list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
                return pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                     pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.int32())],
                    names=_NAMES,
                )

            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                own = tokens(text)
                found = np.fromiter(map(classes.__getitem__, own), np.int32, len(own))
                rare = found >= cut
                local = list(map(places.__getitem__, compress(own, rare.tolist())))
                rows.append((
                    chunk, place, len(own), len(own) - len(local), float(logs[found[~rare]].sum()),
                    found.astype("<u2").tobytes(), np.asarray(local, dtype="<u4").tobytes(),
                ))
                place, size = place + 1, size + len(text)
                if len(places) >= CHUNK_TYPES or size >= CHUNK_CHARS:
                    yield table(i + 1)
                    yield _dictionary(chunk, places, kind)
                    start, rows = i + 1, []
                    chunk, place, size = chunk + 1, 0, 0
                    places.clear()
            if rows:
                yield table(batch.num_rows)
        if place:
            yield _dictionary(chunk, places, kind)

    return run


_NAMES = [
    "doc", "training", "chunk", "place", "n_tokens", "n_top", "top_sum", "classes", "locals", "token", "local",
]


def _dictionary(chunk: int, places: dict[bytes, int], kind: pa.DataType) -> pa.RecordBatch:
    n = len(places)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, kind), pa.nulls(n, pa.bool_()), pa.array([chunk] * n, pa.int64()), pa.nulls(n, pa.int32()),
         pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.binary()),
         pa.nulls(n, pa.binary()), pa.array(list(places), pa.binary()), pa.array(list(places.values()), pa.int32())],
        names=_NAMES,
    )


@dataclass
class Chain:
    """Parameters over classes; ``emit`` has a row for each class."""

    first: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def stationary(self) -> np.ndarray:
        at = np.full(len(self.first), 1 / len(self.first))
        for _ in range(200):
            at = at @ self.move
        return at / at.sum()


def first_chain(counts: np.ndarray, states: int) -> Chain:
    """Sticky states with the classes' frequencies, made different at random."""
    rng = np.random.default_rng(SEED)
    share = (counts + SMOOTH) / (counts + SMOOTH).sum()
    emit = share[:, None] * np.exp(rng.normal(size=(len(counts), states)))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Chain(np.full(states, 1 / states), move, emit / emit.sum(0))


def _by_time(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, active, classes): sequences from long to short; how many reach each step; their classes step by step."""
    sizes = np.asarray([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate([sequences[i] for i in order]).astype(np.int32)
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    step = np.arange(len(flat)) - np.repeat(starts, sizes)
    # of each step, the sequences in order
    at = np.concatenate([[0], np.cumsum(active)])
    rank = np.repeat(np.arange(len(sizes)), sizes)
    out = np.empty_like(flat)
    out[at[step] + rank] = flat
    return order, active, out


def forward(chain: Chain, sequences: list[np.ndarray]) -> np.ndarray:
    """Log likelihood of every sequence."""
    order, active, classes = _by_time(sequences)
    total, at, alpha = np.zeros(len(sequences)), 0, np.empty(0)
    for t, n in enumerate(active.tolist()):
        emit = chain.emit[classes[at : at + n]]
        alpha = (chain.first if t == 0 else alpha[:n] @ chain.move) * emit
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        total[:n] += np.log(scale)
        at += n
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(chain: Chain, sequences: list[np.ndarray], begins: np.ndarray, start: np.ndarray):
    """(log likelihood, first, move, emit) expected over the sequences.

    ``begins``: whether a sequence is the beginning of its text; others start from ``start``.
    """
    order, active, classes = _by_time(sequences)
    states, emit = len(chain.first), chain.emit.astype(np.float32)
    move = chain.move.astype(np.float32)
    own = begins[order]
    alphas = np.empty((len(classes), states), dtype=np.float32)
    scales = np.empty(len(classes), dtype=np.float32)
    edge = np.concatenate([[0], np.cumsum(active)])
    alpha = np.where(own[:, None], chain.first, start).astype(np.float32)
    for t, n in enumerate(active.tolist()):
        a, b = edge[t], edge[t + 1]
        alpha = (alpha if t == 0 else alpha[:n] @ move) * emit[classes[a:b]]
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        alphas[a:b], scales[a:b] = alpha, scale
    moves = np.zeros((states, states))
    beta = np.ones((active[-1], states), dtype=np.float32)
    for t in range(len(active) - 1, 0, -1):
        a, b, n = edge[t], edge[t + 1], active[t]
        ahead = beta * emit[classes[a:b]] / scales[a:b, None]
        alphas[a:b] *= beta
        moves += alphas[edge[t - 1] : edge[t - 1] + n].T @ ahead
        beta = np.ones((active[t - 1], states), dtype=np.float32)
        beta[:n] = ahead @ move.T
    alphas[: edge[1]] *= beta
    begun = alphas[: edge[1]][own].sum(0, dtype=np.float64)
    emitted = np.stack([np.bincount(classes, weights=alphas[:, k], minlength=len(emit)) for k in range(states)], 1)
    return float(np.log(scales, dtype=np.float64).sum()), begun, moves * chain.move, emitted


def _groups(sequences: Iterator, size=len) -> Iterator[list]:
    held, count = [], 0
    for s in sequences:
        held.append(s)
        count += size(s)
        if count >= GROUP:
            yield held
            held, count = [], 0
    if held:
        yield held


def _expect(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: Chain = model.value
        start = chain.stationary()
        states, size = len(chain.first), len(chain.emit)
        total = np.zeros(1 + states + states * states + size * states)

        def segments():
            for batch in batches:
                for data in batch.column(0):
                    whole = np.frombuffer(data.as_py(), "<u2")
                    for i in range(0, len(whole), SEGMENT):
                        yield i == 0, whole[i : i + SEGMENT]

        for group in _groups(segments(), lambda s: len(s[1])):
            parts = expected_counts(chain, [s for _, s in group], np.asarray([b for b, _ in group]), start)
            total += np.concatenate([np.ravel(p) for p in parts])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["parameter", "expected"])

    return run


def train_chain(training: DataFrame, vocabulary: Vocabulary, states: int, passes: int) -> tuple[Chain, list[float]]:
    """Baum-Welch over the encoded training rows; also the log likelihood before each pass."""
    spark = training.sparkSession
    counts = vocabulary.class_counts
    chain, history = first_chain(counts, states), []
    share = (counts + SMOOTH) / (counts + SMOOTH).sum()
    for _ in range(passes):
        model = spark.sparkContext.broadcast(chain)
        sums = (
            training.select("classes").mapInArrow(_expect(model), "parameter long, expected double")
            .groupBy("parameter").agg(F.sum("expected").alias("expected")).toArrow()
        )  # a row per parameter of the model
        total = np.zeros(1 + states + states**2 + len(counts) * states)
        total[sums.column("parameter").to_numpy()] = sums.column("expected").to_numpy()
        history.append(float(total[0]))
        first, move, emit = np.split(total[1:], [states, states + states**2])
        move, emit = move.reshape(states, states) + SMOOTH, emit.reshape(-1, states) + share[:, None]
        chain = Chain((first + SMOOTH) / (first + SMOOTH).sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        model.unpersist()
    return chain, history


def _score(model, scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: Chain = model.value
        whole = Chain(chain.first, chain.move, chain.emit / scale[:, None])
        for batch in batches:
            at = batch.schema.names.index("classes")
            kept = [n for n in batch.schema.names if n != "classes"]
            sequences = (np.frombuffer(x.as_py(), "<u2") for x in batch.column(at))
            done = [forward(whole, group) for group in _groups(sequences)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(np.concatenate(done) / np.log(10))],
                names=[*kept, "class_score"],
            )

    return run


def _tail_sums(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Per text of a chunk: sum of log10(count + 0.1) of its rare tokens, and how many are known."""
    local = words.column("local").to_numpy()
    counts = np.zeros(int(local.max()) + 1 if len(local) else 0, dtype=np.int64)
    counts[local] = words.column("n").to_numpy()
    logs = np.log10(counts + SMOOTH)
    sums, known = [], []
    for data in docs.column("locals"):
        at = np.frombuffer(data.as_py(), "<u4")
        sums.append(float(logs[at].sum()))
        known.append(int((counts[at] > 0).sum()))
    return pa.table({
        "chunk": docs.column("chunk"), "place": docs.column("place"),
        "tail_sum": pa.array(sums, pa.float64()), "n_tail": pa.array(known, pa.int64()),
    })


def score_documents(
    docs: DataFrame,
    training: Column,
    *,
    keep: Sequence[str] | None = None,
    text_col: str = "text",
    states: int = STATES,
    passes: int = PASSES,
) -> DataFrame:
    """(doc struct, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from the rows where ``training`` holds. Scores are log10 probabilities:
    ``base_score`` of single tokens, ``score`` of the model.
    """
    spark = docs.sparkSession
    counts, words = count_tokens(docs.where(training), text_col)
    vocabulary = spark.sparkContext.broadcast(words)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("doc"),
        F.coalesce(training, F.lit(False)).alias("training"),
        F.col(text_col).alias("body"),
    )
    schema = (
        f"doc {rows.schema['doc'].dataType.simpleString()}, training boolean, chunk long, place int, n_tokens long, "
        "n_top long, top_sum double, classes binary, locals binary, token binary, local int"
    )
    encoded = stored(rows.mapInArrow(_encode(vocabulary), schema), "encoded-texts")
    texts = encoded.where("place is not null")
    chain, _ = train_chain(texts.where("training"), words, states, passes)
    model = spark.sparkContext.broadcast(chain)

    dictionary = encoded.where("place is null").select("chunk", "local", "token").join(counts, "token", "left")
    found = dictionary.select(F.col("chunk").alias("of_chunk"), "local", F.coalesce("n", F.lit(0)).alias("n"))
    tails = (
        texts.select("chunk", "place", "locals").groupBy("chunk").cogroup(found.groupBy("of_chunk"))
        .applyInArrow(_tail_sums, "chunk long, place int, tail_sum double, n_tail long")
    )
    scored = texts.select("doc", "chunk", "place", "n_tokens", "n_top", "top_sum", "classes")
    kinds = ", ".join(f"{c} {scored.schema[c].dataType.simpleString()}" for c in scored.columns if c != "classes")
    scored = scored.mapInArrow(_score(model, words.tail_scale), f"{kinds}, class_score double")
    per_token = float(np.log10(words.total + SMOOTH * (words.types + 1)))
    return scored.join(tails, ["chunk", "place"]).select(
        "doc",
        "n_tokens",
        (F.col("n_top") + F.col("n_tail")).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("top_sum") + F.col("tail_sum") - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("class_score") + F.col("tail_sum")).alias("score"),
    )
