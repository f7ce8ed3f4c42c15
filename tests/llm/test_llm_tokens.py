"""Chunked BPE, Elias-Fano boundaries and token files against the libraries themselves."""

import base64
import functools
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelspark.llm.chunked_bpe import decode_documents, encode_documents
from panelspark.llm.elias_fano import EliasFano
from panelspark.llm.common import new_folder
from panelspark.llm.token_files import UnitEncoder, digest_token_files, read_token_files, write_token_files

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")

TEXTS = [
    None, "", " ", "\n", "a", "That it.", "That it.", " lead", "trail ", "two  spaces\n\nand\tlines \n x　y z",
    "it's we'll they're'll", "<|endoftext|> </s> [INST]", "x" * 700, "word " * 400, "É étion çé\nüß 日本語 1234567 !!??\n" * 40,
    " " * 300 + "end", "a <|endoftext|> b<|endoftext|>c\n<|endoftext|>  <|endoftext|>, d.<|endoftext|>", "a\x00b \x00c\x00 d", "\x00", "a\x1cb c\x1c d", "we'r" * 90, "\n".join(["line one.", "line two."] * 60),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i // 2 if i < 8 else i, t, "x", i) for i, t in enumerate(TEXTS)] + [(None, "no id " * 80, None, 0)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, piece int").repartition(3)


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (100, 40), (1 << 15, 1 << 9)])
def test_chunked_encoding_is_that_of_whole_texts(spark, docs, tik, chunk, overlap):
    encoded = encode_documents(docs, RANKS, P.PATTERN, chunk_chars=chunk, overlap_chars=overlap)
    back = decode_documents(encoded, RANKS, P.PATTERN).collect()
    assert len(back) == docs.count()
    for r in back:
        text = r.doc.text or ""
        assert r.ids == tik.encode_ordinary(text), (text[:80], chunk)
        assert bytes(r.decoded) == text.encode()
    assert sorted(str(r.doc) for r in back) == sorted(str(r) for r in docs.collect())


def test_encoding_of_an_empty_table(spark, docs):
    assert encode_documents(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_token_files_round_trip(spark, docs):
    tokenizer = Tokenizer.from_file(JSON)
    path = new_folder(spark, "test-token-files")
    very_long = spark.createDataFrame([(77, "word, " * 200_000, "", 0)], docs.schema)
    docs = docs.unionByName(very_long)
    write_token_files(docs, JSON, path, block_ids=500)
    got = read_token_files(spark, path).orderBy("start").collect()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    for r, (_, text) in zip(got, rows, strict=True):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.ids) == (start, want), text
        start += len(want)
    digests = {r.start: r for r in digest_token_files(spark, path).collect()}
    for r in got:
        d = digests[r.start]
        assert (d.doc_id, d.n_tokens) == (r.doc_id, len(r.ids))
        assert d.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes())


def test_token_files_of_an_empty_table(spark, docs):
    path = new_folder(spark, "test-token-files")
    write_token_files(docs.limit(0), JSON, path)
    assert read_token_files(spark, path).count() == 0


@functools.cache
def library(definition):
    return Tokenizer.from_str(definition)


@settings(deadline=None, max_examples=400)
@given(st.lists(st.sampled_from(
    ["<|endoftext|>", " ", "\n", "a", "b.", "é", ",", "<|", "\t", "\u3000", "\x1f", "it's", "12"]
), max_size=25))
def test_units_are_encoded_as_whole_texts(parts):
    with open(JSON, encoding="utf-8") as f:
        definition = f.read()
    text, encoder = "".join(parts), UnitEncoder.shared(definition)
    want = library(definition).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(pa.array(["x", text]))[1], encoder.dtype).tolist() == want


class Counted:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.characters, self.most = tokenizer, 0, 0

    def encode_batch_fast(self, texts, **options):
        self.characters += sum(map(len, texts))
        self.most = max(self.most, sum(map(len, texts)))
        return self.tokenizer.encode_batch_fast(texts, **options)


def marked_words(n):
    words = ["".join("abcdefghéж"[int(d)] for d in str(i * 7919 + 100_000)) for i in range(n)]
    return [" ".join(w + mark for w in words) for mark in ("", ".", ",", "...", "&&&", "%%%", "!?", ").", "_", "'")]


def test_a_word_is_encoded_once_whatever_marks_follow_it():
    with open(JSON, encoding="utf-8") as f:
        encoder = UnitEncoder(f.read())
    encoder.tokenizer = Counted(encoder.tokenizer)
    texts = marked_words(500)
    got = encoder.encode(pa.array(texts)) + encoder.encode(pa.array(texts[::-1]))[::-1]
    want = [x.ids for x in encoder.tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)] * 2
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in got] == want
    assert encoder.tokenizer.characters < 1.5 * len(texts[0])


@pytest.mark.parametrize("units, size", [(100, 1 << 20), (1 << 20, 2000)])
def test_a_full_dictionary_keeps_what_was_used_last(monkeypatch, units, size):
    monkeypatch.setattr("panelspark.llm.token_files.CACHE_UNITS", units)
    monkeypatch.setattr("panelspark.llm.token_files.CACHE_BYTES", size)
    with open(JSON, encoding="utf-8") as f:
        encoder = UnitEncoder(f.read())
    encoder.tokenizer = Counted(encoder.tokenizer)
    often = marked_words(20)[0]
    texts = [f"{often} {x}" for x in marked_words(90)] + ["x" * 5000, f"{often} <|endoftext|>. a<|endoftext|>"]
    for text in texts:
        got = np.frombuffer(encoder.encode(pa.array([text]))[0], encoder.dtype).tolist()
        assert got == encoder.tokenizer.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.units) <= units and encoder.units.nbytes <= size + 64
    before = encoder.tokenizer.characters
    encoder.encode(pa.array([often]))
    assert encoder.tokenizer.characters == before


def test_the_library_gets_a_part_of_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr("panelspark.llm.token_files.CALL_CHARACTERS", 2000)
    with open(JSON, encoding="utf-8") as f:
        encoder = UnitEncoder(f.read())
    encoder.tokenizer = Counted(encoder.tokenizer)
    texts = [*marked_words(2000), "x" * 900, "y" * 1500, "two  spaces " * 20]
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(pa.array(texts))]
    assert got == [x.ids for x in encoder.tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.tokenizer.most <= 2000 + 1500


@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 6))
def test_elias_fano(gaps, shift):
    values = np.cumsum(np.asarray(gaps, dtype=np.int64) << shift)
    code = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    assert code.values().tolist() == values.tolist()
    assert [code[i] for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    assert len(EliasFano.of(values).to_bytes()) < 10_000 * (2 + 10 + 1.5) / 8


def test_registered_query_matches_the_library(spark, tik):
    from panelspark.llm.catalog import op6_chunked_bpe

    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    got = op6_chunked_bpe(spark, root).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = tik.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
