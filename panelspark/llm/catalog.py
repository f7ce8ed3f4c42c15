"""The registered text queries: thin views of the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import sql
from panelspark.llm.chat_windows import digest_windows, format_conversations
from panelspark.llm.chunked_bpe import decode_documents, encode_documents
from panelspark.llm.common import crc32_mod, documents, new_folder
from panelspark.llm.hard_negatives import mine_hard_negatives
from panelspark.llm.hidden_markov import score_documents
from panelspark.llm.language_id import identify, in_training, train
from panelspark.llm.license_scan import scan_licenses
from panelspark.llm.line_dedup import dedup_lines
from panelspark.llm.ngram_join import jaccard_components
from panelspark.llm.robust_outliers import judge
from panelspark.llm.source_mixing import mix_sources
from panelspark.llm.spherical_caps import near_duplicates
from panelspark.llm.token_files import digest_token_files, write_token_files
from panelspark.llm.whitening import by_component, fit_whitening, identity_error, whiten
from panelspark.sources.tables import read_table

Builder = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Per document: its lines, how many were deleted, and a digest of what is left."""
    done = dedup_lines(documents(spark, root).select("doc_id", "text"))
    return done.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.col("lines").alias("n_lines"),
        F.col("removed").alias("n_removed"),
        F.md5(F.col("kept_text").cast("binary")).alias("kept_md5"),
    )


def op2_hidden_markov(spark: SparkSession, root: str) -> DataFrame:
    held_out = crc32_mod("doc_id", 10) == 0
    scored = score_documents(
        documents(spark, root).withColumn("held_out", held_out), ~held_out, keep=["doc_id", "held_out"]
    )
    return scored.select("doc.doc_id", "doc.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_spherical_caps(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(read_table(spark, root, "embeddings"))


def op4_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    trees = train(docs, in_training())
    found = identify(docs.withColumn("held_out", ~in_training()), trees, keep=["doc_id", "held_out"])
    return found.select("doc.doc_id", "doc.held_out", "lang_pred", "score")


def op5_chat_windows(spark: SparkSession, root: str) -> DataFrame:
    """All conversations, and one more whose texts are control strings of another template."""
    turns = read_table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return digest_windows(format_conversations(turns.unionByName(odd)))


def op6_chunked_bpe(spark: SparkSession, root: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(documents(spark, root), ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    back = decode_documents(encoded, ranks, public_tokenizers.PATTERN)
    return back.select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_robust_outliers(spark: SparkSession, root: str) -> DataFrame:
    judged = judge(documents(spark, root), keep=["doc_id"])
    return judged.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_ngram_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_components(documents(spark, root), keep=["doc_id"]).select("doc.doc_id", "n_shingles", "component_id")


def op9_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    mixed = mix_sources(documents(spark, root), keep=["doc_id"])
    return mixed.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op10_token_files(spark: SparkSession, root: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_token_files(documents(spark, root), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=0)
    return digest_token_files(spark, path)


def op11_license_scan(spark: SparkSession, root: str) -> DataFrame:
    found = scan_licenses(documents(spark, root), keep=["doc_id"])
    return found.select(
        "doc.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op12_whitening(spark: SparkSession, root: str) -> DataFrame:
    vectors = read_table(spark, root, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    error = identity_error(vectors, model)
    return by_component(whiten(vectors, model), model).select(
        "doc.vec_id", "component", "n", "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )


def op13_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    """Every seventh row gets another label; every hundredth is an anchor."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, root, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Builder] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_hidden_markov": op2_hidden_markov,
    "op3_spherical_caps": op3_spherical_caps,
    "op4_language_id": op4_language_id,
    "op5_chat_windows": op5_chat_windows,
    "op6_chunked_bpe": op6_chunked_bpe,
    "op7_robust_outliers": op7_robust_outliers,
    "op8_ngram_join": op8_ngram_join,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_files": op10_token_files,
    "op11_license_scan": op11_license_scan,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op1_line_dedup": sql.LINE_DEDUP,
    "op3_spherical_caps": sql.SPHERICAL_CAPS,
    "op8_ngram_join": sql.NGRAM_JOIN,
    "op9_source_mixing": sql.SOURCE_MIXING,
    "op13_hard_negatives": sql.HARD_NEGATIVES,
}


def queries() -> dict[str, Builder]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
