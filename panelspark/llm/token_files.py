"""Token-ID output: concatenated ids with Elias-Fano document boundaries.

The documents are sorted by id, encoded with a tokenizer of the ``tokenizers``
library, each followed by an end id, and written as a table of blocks (Parquet
through Spark's own writer, so any file system Spark knows will do). A block
holds whole documents: the ids as one array of 2 or 4 bytes an id, as the
vocabulary needs; the Elias-Fano code of the document ends inside the block;
the document ids. A block is closed when it has ``block_ids`` ids, so memory is
bounded by a block and one document. Offsets over the whole corpus are the
block's start (the ids of its shard before it, kept in the file, and a prefix
sum over shards) plus the offset that the select structure returns; a reader asks it for the
two ends of each document it reads.

Encoding goes by units: a run of spaces and line feeds with the text up to the
next run. A unit always begins at a pre-token boundary of the tokenizer's
pattern, and what is inside does not look past its end, so units can be encoded
apart; each distinct one is encoded once per worker while it stays in a bounded
dictionary, a word and the marks behind it as two. Texts with any other white space are encoded whole. Names of special tokens in
a text are encoded as the library does by default, as that token.

Defined results: a null or empty text has the end id only; null document ids
come first; rows of one id are ordered by text; a very long text is one document of a
block of its own size; ids are numbers, or texts of numbers; other columns are not read; an
empty table gives an empty table of blocks.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.elias_fano import EliasFano

BLOCK_IDS = 1 << 20
#: Units, and bytes of them, above which a worker's dictionary is cut to the half used last.
CACHE_UNITS, CACHE_BYTES = 1_000_000, 32 << 20
#: Bytes of text encoded together, new units per string given to the library, and characters per call of it.
SLICE_BYTES, JOINED_UNITS, CALL_CHARACTERS = 16 << 20, 64, 1 << 18

#: What keeps a text from being split at each space: a NUL, white space other than the space and the
#: line feed, or two of these in a row or at an end.
_OTHER = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n") + "\x00"
_ODD = f"[{_OTHER}]|[ \\n][ \\n]|^ | $"
_WHOLE = re.compile(f"[{_OTHER}]")
_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: A unit of a word (Latin or Cyrillic letters) with marks behind it: the marks are a pre-token of their own.
_WORD = "^[\\n\\x00]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0400-\u0481\u048a-\u04ff]+"
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())

BLOCK_SCHEMA = "shard int, block int, before long, n_docs long, n_ids long, width int, doc_ids array<long>, ends binary, ids binary"


class UnitEncoder:
    """Ids of texts as arrays, through one tokenizer and a dictionary of units."""

    _made: dict[int, UnitEncoder] = {}

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        # in a byte-level vocabulary each character of a token stands for one byte
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        special = self.tokenizer.get_added_tokens_decoder()
        for i, token in special.items():
            self.token_bytes[i] = len(token.content.encode())
        self.special = "|".join(re.escape(token.content) for token in special.values())
        # the dictionary: unit i has sizes[i] of the ids from starts[i] on, and was last used in slice used[i]
        self.units = pa.array([], pa.string())
        self.ids = np.empty(0, self.dtype)
        self.starts, self.sizes, self.used = (np.empty(0, np.int32) for _ in range(3))
        self.slices = 0

    @classmethod
    def shared(cls, definition: str) -> UnitEncoder:
        key = zlib.crc32(definition.encode())
        if key not in cls._made:
            cls._made[key] = cls(definition)
        return cls._made[key]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The library's own results are far larger, so it gets a part at a time."""
        filled = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))) // CALL_CHARACTERS
        cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), len(texts)]
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            found = self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)
            out += [np.asarray(x.ids, dtype=self.dtype) for x in found]
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian ids of each text.

        Units are split off, told apart and looked up by Arrow; the ids of the distinct ones
        of the slice are gathered into those of the texts. The space before a unit is left out
        of it, a line feed is part of it, and the first unit of a text begins with a NUL."""
        odd = pc.match_substring_regex(texts, _ODD)
        plain = texts.filter(pc.invert(odd))
        marked = pc.binary_join_element_wise("\x00", pc.replace_substring(plain, "\n", " \n"), "")
        lists = pc.split_pattern(marked, " ")
        units = lists.flatten().dictionary_encode()
        ids, sizes = self._found(units.dictionary)
        index = units.indices.to_numpy(zero_copy_only=False)
        gathered, ends = _gathered(ids, np.cumsum(sizes, dtype=np.int32) - sizes, sizes, index)
        data, width = gathered.tobytes(), self.dtype.itemsize
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.concatenate([[0], ends]).astype(np.int64)[np.cumsum(counts)] * width).tolist()]
        whole = iter([data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
        out = []
        for i, is_odd in enumerate(odd.to_pylist()):
            if is_odd:
                text = texts[i].as_py()
                out.append(b"".join(x.tobytes() for x in self._whole([text] if _WHOLE.search(text) else _UNIT.findall(text))))
            else:
                out.append(next(whole))
        return out

    def _found(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct ``units`` in a row, and how many each has. A word with marks
        behind it is looked up as the word and the marks."""
        words = pc.ascii_rtrim(units, characters=_MARKS)
        apart = np.flatnonzero(pc.not_equal(pc.binary_length(words), pc.binary_length(units)))
        both = units.take(pa.array(apart))
        fits = pc.match_substring_regex(words.take(pa.array(apart)), _WORD + "$")
        if self.special:
            fits = pc.and_not(fits, pc.match_substring_regex(both, self.special))
        apart, both = apart[fits.to_numpy(zero_copy_only=False)], both.filter(fits)
        is_apart = np.zeros(len(units), bool)
        is_apart[apart] = True
        marks = pc.binary_join_element_wise("\x00", pc.replace_substring_regex(both, _WORD, ""), "")
        parts = pa.concat_arrays([pc.if_else(pa.array(is_apart), words, units), marks]).dictionary_encode()
        place = self._places(parts.dictionary)[parts.indices.to_numpy(zero_copy_only=False)]
        first = np.arange(len(units)) + np.cumsum(is_apart) - is_apart
        order = np.empty(len(place), place.dtype)
        order[first], order[first[apart] + 1] = place[: len(units)], place[len(units) :]
        ids, ends = _gathered(self.ids, self.starts, self.sizes, order)
        sizes = np.diff(ends[first + is_apart], prepend=np.int32(0))
        self._trim()
        return ids, sizes

    def _places(self, units: pa.Array) -> np.ndarray:
        """Where distinct ``units`` are in the dictionary; those not in it are encoded and added."""
        found = pc.index_in(units, value_set=self.units)
        place = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).copy()
        if found.null_count:
            new = units.filter(pc.is_null(found))
            alone = pc.or_(pc.starts_with(new, "\x00"), pc.or_(pc.ends_with(new, "\n"), pc.equal(new, "")))
            lone, joined = new.filter(alone), new.filter(pc.invert(alone))
            new = pa.concat_arrays([joined, lone])
            ids, sizes = self._learn(joined)
            each = self._whole([_text(u) for u in lone.to_pylist()])
            sizes = np.concatenate([sizes, np.fromiter(map(len, each), np.int32, len(each))])
            self.starts = np.concatenate([self.starts, np.cumsum(sizes, dtype=np.int32) - sizes + np.int32(len(self.ids))])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids, *each])
            unknown, known = place < 0, len(self.units)
            at = np.empty(len(new), place.dtype)
            is_alone = alone.to_numpy(zero_copy_only=False)
            at[~is_alone] = np.arange(known, known + len(joined))
            at[is_alone] = np.arange(known + len(joined), known + len(new))
            place[unknown] = at
            self.units = pa.concat_arrays([self.units, new])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
        self.slices += 1
        self.used[place] = self.slices
        return place

    def _learn(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new units in a row, and how many each has: many are encoded in one
        string, and its ids are cut where the units end."""
        if not len(units):
            return np.empty(0, self.dtype), np.empty(0, np.int32)
        strings = pc.if_else(pc.starts_with(units, "\n"), units, pc.binary_join_element_wise("", units, " "))
        limits = np.append(np.arange(0, len(units), JOINED_UNITS, dtype=np.int32), np.int32(len(units)))
        found = self._whole(pc.binary_join(pa.ListArray.from_arrays(pa.array(limits), strings), "").to_pylist())
        ids = np.concatenate(found)
        ends = np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False), dtype=np.int64)
        reached = np.cumsum(self.token_bytes[ids])
        last = np.searchsorted(reached, ends)
        strings_end = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) - 1
        if (last[limits[1:] - 1] == strings_end).all() and (reached[last] == ends).all():
            return ids, np.diff(last, prepend=-1).astype(np.int32)
        if len(found) > 1:  # a unit does not end at a token: string by string
            parts = [self._learn(units.slice(i, JOINED_UNITS)) for i in limits[:-1].tolist()]
            return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        found = self._whole(strings.to_pylist())
        return np.concatenate(found), np.fromiter(map(len, found), np.int32, len(found))

    def _trim(self) -> None:
        """Cuts a full dictionary to half its bounds; what was used last stays."""
        if len(self.units) <= CACHE_UNITS and self.units.nbytes <= CACHE_BYTES:
            return
        order = np.argsort(-self.used, kind="stable")[: CACHE_UNITS // 2]
        size = pc.binary_length(self.units).to_numpy(zero_copy_only=False)[order] + 4
        order = np.sort(order[np.cumsum(size, dtype=np.int64) <= CACHE_BYTES // 2])
        self.units, self.used = self.units.take(pa.array(order)), self.used[order]
        self.ids, ends = _gathered(self.ids, self.starts, self.sizes, order)
        self.sizes = self.sizes[order]
        self.starts = ends - self.sizes


def _text(unit: str) -> str:
    """The text of a unit: see ``UnitEncoder.encode``."""
    return unit[1:] if unit[:1] == "\x00" else unit if unit[:1] == "\n" else f" {unit}"


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units ``index`` in a row, and where each ends."""
    lengths = sizes[index]
    ends = np.cumsum(lengths, dtype=np.int32)
    place = np.repeat(starts[index] - (ends - lengths), lengths)
    place += np.arange(len(place), dtype=np.int32)
    return ids[place], ends


def _write_blocks(definition, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder.shared(definition.value)
        shard, block = TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], dtype=encoder.dtype).tobytes()
        names, parts, total, before = [], [], 0, 0

        def closed() -> pa.RecordBatch:
            nonlocal block, total, before
            ends = np.cumsum([len(p) // encoder.dtype.itemsize for p in parts])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([len(parts)], pa.int64()),
                    pa.array([total], pa.int64()),
                    pa.array([encoder.dtype.itemsize], pa.int32()),
                    pa.array([list(names)], pa.list_(pa.int64())),
                    pa.array([EliasFano.of(ends).to_bytes()], pa.binary()),
                    pa.array([b"".join(parts)], pa.binary()),
                ],
                names=["shard", "block", "before", "n_docs", "n_ids", "width", "doc_ids", "ends", "ids"],
            )
            names.clear()
            parts.clear()
            block, before, total = block + 1, before + total, 0
            return row

        for ids, texts in _slices(batches):
            for name, data in zip(ids, encoder.encode(texts), strict=True):
                names.append(name)
                parts.append(data + end)
                total += len(parts[-1]) // encoder.dtype.itemsize
                if total >= block_ids:
                    yield closed()
        if parts:
            yield closed()

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
    """(ids, texts) of about ``SLICE_BYTES`` each, or of one text."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
        filled = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield ids[a:b], texts.slice(a, b - a)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Writes the blocks of ``docs`` to ``path``. The definition of the tokenizer
    is read once, on the driver, and sent to the executors with the job."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "body")
    blocks = ordered.mapInArrow(_write_blocks(definition, end_id, block_ids), BLOCK_SCHEMA)
    blocks.write.option("compression", "zstd").parquet(path)


def _ends(code: bytes) -> np.ndarray:
    """Where each document of a block ends, by select."""
    boundaries = EliasFano.from_bytes(code)
    return np.fromiter((boundaries[i] for i in range(boundaries.count)), np.int64, boundaries.count)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            first, width, doc_ids, ends, data = (batch.column(c)[row].as_py() for c in range(5))
            limits = _ends(ends)
            starts = np.concatenate([[0], limits[:-1]])
            ids = np.frombuffer(data, "<u2" if width == 2 else "<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + first, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([starts, limits[-1:]]), pa.int32()), pa.array(ids.astype(np.int32))
                    ),
                ],
                names=["doc_id", "start", "ids"],
            )


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with the number of ids before each. There is a shard per task that
    wrote, so the table of their starts is small at any size of the corpus."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    starts = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_start"))
    return blocks.join(F.broadcast(starts), "shard").select(
        (F.col("before") + F.col("shard_start")).alias("first"), "width", "doc_ids", "ends", "ids"
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of the files."""
    return _blocks(spark, path).mapInArrow(_read_blocks, "doc_id long, start long, ids array<int>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            first, width, doc_ids, ends, data = (batch.column(c)[row].as_py() for c in range(5))
            limits = _ends(ends)
            starts = np.concatenate([[0], limits[:-1]])
            wide = np.frombuffer(data, "<u2" if width == 2 else "<u4").astype("<u4")
            sums = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), limits.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + first, pa.int64()),
                    pa.array(limits - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def digest_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    return _blocks(spark, path).mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")

