"""Corpus pipeline: from raw documents to token ids in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all
rows its predecessor kept; all but the last return the columns of ``docs``.
``run`` writes every stage's result as Parquet to the shared folder of the
session and reads it back as the next one's input.

1. language ID     learns from all labelled rows (a bounded sample, see the
                   operator); rows whose text has no letter, or whose best
                   language has a posterior below one half, go.
2. line dedup      later repeated runs of lines are cut from the texts; rows
                   that had words and have none left go.
3. near duplicates of each group of linked documents (Jaccard >= 0.8 of their
                   5-word shingles) the one with the smallest id stays;
                   documents without words stay; of rows that repeat an id (or have
                   none) with the same text one stays.
4. source mixing   rows are repeated or left out, as the targets ask.
5. byte-level BPE  ids of every text, and whether they decode to its bytes.

Nulls, empty tables, repeated rows and extra columns are handled as the
operators' docstrings say. Where no row is labelled, only texts without a letter
go in the first stage. ``n_chars`` follows the text where there is such a column.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.chunked_bpe import decode_documents, encode_documents
from panelspark.llm.common import WORD, documents, stored
from panelspark.llm.language_id import UNKNOWN, identify, train
from panelspark.llm.line_dedup import dedup_lines
from panelspark.llm.ngram_join import jaccard_components
from panelspark.llm.source_mixing import emit_copies, mix_sources

#: Least posterior of the predicted language.
LEAST_SCORE = 0.5
#: Words of a shingle and least Jaccard similarity in percent of near copies; op8 has its own.
SHINGLE, PERCENT = 5, 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = train(docs, F.lit(True))
    if not trees.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, trees)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = dedup_lines(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    emptied = (F.col("removed") > 0) & ~F.coalesce(F.regexp_like("kept_text", F.lit(WORD)), F.lit(False))
    return done.where(~emptied).select(
        *[
            F.when(F.col("removed") > 0, changed[c]).otherwise(F.col(f"doc.`{c}`")).alias(c)
            if c in changed else F.col(f"doc.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_components(docs, shingle=SHINGLE, percent=PERCENT)
    stays = F.col("component_id").isNull() | (F.col("doc.doc_id") == F.col("component_id"))
    same = Window.partitionBy("doc.doc_id", F.md5(F.col("doc.text").cast("binary"))).orderBy(F.xxhash64("doc"))
    first = found.where(stays).withColumn("copy", F.row_number().over(same)).where(F.col("copy") == 1)
    return first.select("doc.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return emit_copies(mix_sources(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_documents(docs, ranks, pattern, keep=["doc_id", "lang", "source", "text"])
    encoded = stored(encoded, "encoded-documents")  # a task has one Python worker at a time
    back = decode_documents(encoded, ranks, pattern)
    return back.select(
        "doc.doc_id",
        "doc.lang",
        "doc.source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("doc.text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: The context trees of the first stage are no SQL; see tests/llm for the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
