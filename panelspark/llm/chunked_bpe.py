"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel and stitched.

A text is cut into chunks of ``chunk_chars`` characters that overlap by
``overlap_chars``. Each chunk is split by the pre-token pattern by itself, from
its own start. A chunk may begin inside a pre-token, so its first boundaries can
be wrong; but a scan goes on from a boundary in only one way, so from the first
boundary that a chunk shares with the chunk before it, both agree. There the two
are stitched. Boundaries less than ``GUARD`` characters before the end of a chunk
are not compared, as the cut may have changed them. Then the pre-tokens between
two stitches are encoded, chunk by chunk, and the ids put together in order.

If two neighbours share no boundary (one pre-token longer than the overlap), the
document is put together again and scanned as one piece: the exact way for the
rest. Texts of one chunk need no stitching and take no shuffle.

Each pre-token is encoded with the rank file's merges, once per worker while it
stays in a bounded dictionary. Decoding concatenates the bytes of the ids.

Defined results: null and empty texts have no ids; rows of equal id and long
text are worked on once and come out as often as they went in; special tokens
are ordinary text; extra columns are kept in one struct.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import text_hash

CHUNK_CHARS, OVERLAP_CHARS = 1 << 15, 1 << 9
#: A contraction is at most this long, so a cut can change no boundary further back.
GUARD = 4
CACHE_TOKENS = 300_000
#: Ids and bytes of a batch that goes back to Spark.
SLICE_BYTES = 4 << 20


class Vocabulary:
    """Ranks, pre-token pattern and the bytes of each id."""

    _made: dict[int, Vocabulary] = {}

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.tokens = _Tokens(self.encoding)

    @classmethod
    def shared(cls, rank_file: bytes, pattern: str) -> Vocabulary:
        key = zlib.crc32(rank_file + pattern.encode())
        if key not in cls._made:
            cls._made[key] = cls(rank_file, pattern)
        return cls._made[key]

    def cuts(self, piece: str) -> np.ndarray:
        """Ends of the pre-tokens of a piece, in characters."""
        return np.cumsum([len(t) for t in self.pattern.findall(piece)], dtype=np.int32)

    def encode(self, pre_tokens: list[str]) -> bytes:
        """Ids of pre-tokens as little-endian 32-bit integers."""
        if len(self.tokens) > CACHE_TOKENS:
            self.tokens.clear()
        return b"".join(map(self.tokens.__getitem__, pre_tokens))


class _Tokens(dict):
    """Ids of a pre-token; encodes it when it is asked for the first time."""

    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, token: str) -> bytes:
        ids = np.asarray(self.encoding.encode_ordinary(token), dtype="<i4").tobytes()
        self[token] = ids
        return ids


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(p) // 4 for p in parts]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _scan(vocabulary, pattern: str):
    """Adds the pre-token boundaries of each chunk (column ``piece``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.shared(vocabulary.value, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                cuts = pa.array([words.cuts(row.column("piece")[0].as_py())], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*row.columns, cuts], names=[*row.schema.names, "cuts"])

    return run


def _encode_cut(vocabulary, pattern: str):
    """Encodes each piece between ``from_cut`` and ``to_cut`` by its boundaries ``cuts``.

    Without boundaries the whole piece is split here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.shared(vocabulary.value, pattern)
        for batch in batches:
            names = batch.schema.names
            kept = [n for n in names if n not in ("piece", "cuts", "from_cut", "to_cut")]
            pieces, cuts = batch.column("piece"), batch.column("cuts") if "cuts" in names else None
            start, parts, size = 0, [], 0
            for i in range(batch.num_rows):
                text = pieces[i].as_py() or ""
                if cuts is None:
                    tokens = words.pattern.findall(text)
                else:
                    low, high = batch.column("from_cut")[i].as_py(), batch.column("to_cut")[i].as_py()
                    at = [c for c in cuts[i].as_py() if low < c <= high]
                    tokens = [text[a:b] for a, b in zip([low, *at], at, strict=False)]
                parts.append(words.encode(tokens))
                size += len(parts[-1])
                if size >= SLICE_BYTES or i == batch.num_rows - 1:
                    done = batch.slice(start, len(parts))
                    yield pa.RecordBatch.from_arrays(
                        [*[done.column(n) for n in kept], _lists(parts)], names=[*kept, "ids"]
                    )
                    start, parts, size = i + 1, [], 0

    return run


def _ddl(df: DataFrame, columns: Sequence[str], extra: str) -> str:
    parts = [f"{c} {df.schema[c].dataType.simpleString()}" for c in columns]
    return ", ".join([*parts, extra])


def encode_documents(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    *,
    keep: Sequence[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(doc struct, ids array<int>) of every document; ``keep`` names the columns in ``doc`` (default: all)."""
    if not GUARD < overlap_chars <= chunk_chars:
        raise ValueError("the overlap must be longer than the guard and not longer than a chunk")
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("doc"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("piece"),
    )
    short = F.coalesce(F.length("piece"), F.lit(0)) <= chunk_chars
    encode = _encode_cut(ranks, pattern)
    one = rows.where(short).select("doc", "piece")
    done = one.mapInArrow(encode, _ddl(one, ["doc"], "ids array<int>"))

    many = rows.where(~short).withColumn("hash", text_hash("piece")).withColumn("n", F.length("piece"))
    last = F.ceil(F.col("n") / chunk_chars).cast("int") - 1
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("part"),
            F.substring(F.col("piece"), i * chunk_chars + 1, F.lit(chunk_chars + overlap_chars)).alias("piece"),
            F.when(i == 0, F.col("doc")).alias("doc"),
            (i == last).alias("is_last"),
        ),
    )
    key = ["id", "hash", "n"]
    chunks = (
        many.select(*key, F.explode(cut).alias("c"))
        .select(*key, "c.*")
        .groupBy(*key, "part")
        .agg(F.first("piece").alias("piece"), F.first("is_last").alias("is_last"), F.collect_list("doc").alias("docs"))
    )
    scanned = chunks.mapInArrow(_scan(ranks, pattern), _ddl(chunks, chunks.columns, "cuts array<int>"))
    order = Window.partitionBy(*key).orderBy("part")
    # the boundaries of the overlap, counted from the start of the later chunk
    tail = F.transform(
        F.filter("cuts", lambda c: (c >= chunk_chars) & (c <= F.length("piece") - GUARD)), lambda c: c - chunk_chars
    )
    met = F.array_min(F.array_intersect(F.col("before"), F.filter("cuts", lambda c: c <= overlap_chars)))
    stitched = (
        scanned.withColumn("before", F.lag(F.when(~F.col("is_last"), tail)).over(order))
        .withColumn("from_cut", F.when(F.col("part") == 0, F.lit(0)).otherwise(met))
        .withColumn("to_cut", F.lead("from_cut").over(order) + F.lit(chunk_chars))
        .withColumn("to_cut", F.when(F.col("is_last"), F.length("piece")).otherwise(F.col("to_cut")))
        .withColumn(
            "apart", F.max(F.col("from_cut").isNull()).over(Window.partitionBy(*key))
        )
    )
    pieces = stitched.where(~F.col("apart")).select(*key, "part", "docs", "piece", "cuts", "from_cut", "to_cut")
    by_part = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("part", c))), lambda x: x[c])
    encoded = pieces.mapInArrow(encode, _ddl(pieces, [*key, "part", "docs"], "ids array<int>"))
    joined = encoded.groupBy(*key).agg(
        F.flatten(by_part("ids")).alias("ids"), F.flatten(F.collect_list("docs")).alias("docs")
    )
    whole = (
        stitched.where("apart")
        .withColumn("own", F.substring("piece", 1, chunk_chars))
        .groupBy(*key)
        .agg(F.array_join(by_part("own"), "").alias("piece"), F.flatten(F.collect_list("docs")).alias("docs"))
        .select("docs", "piece")
    )
    rescanned = whole.mapInArrow(encode, _ddl(whole, ["docs"], "ids array<int>"))
    rest = joined.select("docs", "ids").unionByName(rescanned).select(F.explode("docs").alias("doc"), "ids")
    return done.unionByName(rest)


def _decode(vocabulary, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Vocabulary.shared(vocabulary.value, pattern).bytes_of
        for batch in batches:
            at = batch.schema.names.index("ids")
            start, parts, size = 0, [], 0
            for i in range(batch.num_rows):
                ids = batch.column(at)[i].values
                parts.append(b"".join(map(table.__getitem__, ids.to_numpy(zero_copy_only=False).tolist())))
                size += len(parts[-1])
                if size >= SLICE_BYTES or i == batch.num_rows - 1:
                    done = batch.slice(start, len(parts))
                    yield pa.RecordBatch.from_arrays(
                        [*done.columns, pa.array(parts, pa.binary())], names=[*batch.schema.names, "decoded"]
                    )
                    start, parts, size = i + 1, [], 0

    return run


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids`` one after another."""
    with open(rank_path, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())
    return encoded.mapInArrow(_decode(ranks, pattern), _ddl(encoded, encoded.columns, "decoded binary"))
