"""Line dedup by winnowing over line hashes (native).

A run is a sequence of consecutive lines (lines without a word do not count)
with at least ``min_words`` words. Of the runs that occur more than once in the
corpus, every occurrence but the first, in the order of document and line, is
deleted.

The windows of the winnowing are the shortest runs of ``min_words`` words that
start at a line, and the shortest that end at a line. From each window its
smallest line hash (the last one of equals) is selected as a fingerprint: equal
windows select the same line, so two copies of a run are guaranteed to share a
fingerprint. Fingerprints are joined on their hash; where a fingerprint has
more than one position, the match is extended to both sides, over the windows
around it, and the windows that have an earlier equal are deleted. The windows
that start and those that end in a run together cover all of it, so what is
deleted are maximal runs.

Each line has a 128-bit hash, each window the hash of its lines' hashes.
Only fingerprints and windows are shuffled (map-side combined minima; joins on
plain keys, whose hot keys Spark can split); no occurrence is paired with
another, each is compared with the first one.

Defined results: null and empty texts stay as they are; documents are ordered
by id (null first), then by a hash of the text; rows with equal id and text are
one document and get the same result; within a document a run that repeats
itself keeps its first lines. Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import WORD, saved, text_hash

MIN_WORDS = 50


def _shortest(words: Column, from_line: Column, count: Column, need: int, backwards: bool) -> Column:
    """Lines from ``from_line`` on (or back) until ``need`` words are reached; 0 if they are not."""
    # every line has a word, so ``need`` lines are enough
    if backwards:
        span = F.least(from_line + 1, F.lit(need))
        part = F.reverse(F.slice(words, from_line - span + 2, span))
    else:
        part = F.slice(words, from_line + 1, F.least(count - from_line, F.lit(need)))
    none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))
    return F.aggregate(
        part,
        none,
        lambda a, x: F.when(a["words"] >= need, a).otherwise(
            F.struct((a["words"] + x).alias("words"), (a["lines"] + 1).alias("lines"))
        ),
        lambda a: F.when(a["words"] >= need, a["lines"]).otherwise(F.lit(0)),
    )


def line_windows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(row_id, row_hash, first line, last line, k1, k2, mark, mark line) of every window."""
    lines = docs.where(F.length(text_col) > 0).select(
        F.col(id_col).alias("row_id"),
        text_hash(text_col).alias("row_hash"),
        F.filter(
            F.transform(
                F.split(F.col(text_col), "\n", -1),
                lambda x, i: F.struct(
                    i.alias("line"),
                    F.regexp_count(x, F.lit(WORD)).alias("words"),
                    F.xxhash64(x).alias("h1"),
                    F.xxhash64(x, F.lit(1)).alias("h2"),
                ),
            ),
            lambda x: x["words"] > 0,
        ).alias("lines"),
    )
    columns = lines.select(
        "row_id", "row_hash", F.size("lines").alias("n"),
        *[F.col(f"lines.{c}").alias(c) for c in ("line", "words", "h1", "h2")],
    ).where("n > 0")
    at = F.sequence(F.lit(0), F.col("n") - 1)
    forward = F.transform(
        at, lambda s: F.struct(s.alias("s"), _shortest(F.col("words"), s, F.col("n"), min_words, False).alias("k"))
    )
    backward = F.transform(
        F.transform(
            at, lambda e: F.struct(e.alias("e"), _shortest(F.col("words"), e, F.col("n"), min_words, True).alias("k"))
        ),
        lambda x: F.struct((x["e"] - x["k"] + 1).alias("s"), x["k"].alias("k")),
    )
    windows = F.filter(F.array_distinct(F.concat(forward, backward)), lambda x: x["k"] > 0)
    return (
        columns.select("*", F.explode(windows).alias("w"))
        .select(
            "row_id", "row_hash", "line", F.col("w.s").alias("s"), F.col("w.k").alias("k"),
            F.slice("h1", F.col("w.s") + 1, F.col("w.k")).alias("a1"),
            F.slice("h2", F.col("w.s") + 1, F.col("w.k")).alias("a2"),
        )
        .select(
            "row_id", "row_hash",
            F.element_at("line", F.col("s") + 1).alias("first_line"),
            F.element_at("line", F.col("s") + F.col("k")).alias("last_line"),
            F.xxhash64("a1").alias("k1"),
            F.xxhash64("a2").alias("k2"),
            F.array_min("a1").alias("mark"),
            # the last of equal minima: its place counted from the window's end
            (F.col("s") + F.col("k") - F.array_position(F.reverse("a1"), F.array_min("a1"))).alias("mark_line"),
        )
    )


def repeated_spans(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(row_id, row_hash, spans): per document the line spans that repeat earlier ones."""
    windows = saved(line_windows(docs, id_col, text_col, min_words))
    position = F.struct("row_id", "row_hash", "mark_line")
    shared = (
        windows.groupBy("mark")
        .agg(F.min(position).alias("low"), F.max(position).alias("high"))
        .where("low <> high")
        .select("mark")
    )
    matches = windows.join(shared, "mark", "left_semi")
    place = F.struct("row_id", "row_hash", "first_line")
    firsts = (
        matches.groupBy("k1", "k2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .select("k1", "k2", "first")
    )
    later = matches.join(firsts, ["k1", "k2"]).where(place > F.col("first"))
    return later.groupBy("row_id", "row_hash").agg(
        F.collect_set(F.struct("first_line", "last_line")).alias("spans")
    )


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc struct, lines, removed, kept_text): every document without its later repeated runs.

    ``lines`` counts the lines with a word, ``removed`` those of them deleted.
    """
    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, min_words=min_words)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(id_col).alias("id"),
        text_hash(text_col).alias("hash"),
        F.col(text_col).alias("body"),
    )
    joined = rows.join(
        spans, F.col("id").eqNullSafe(F.col("row_id")) & (F.col("hash") == F.col("row_hash")), "left"
    )
    gone = F.array_distinct(
        F.flatten(F.transform("spans", lambda x: F.sequence(x["first_line"], x["last_line"])))
    )
    split = joined.withColumn("all_lines", F.split("body", "\n", -1)).withColumn(
        "kept_at",
        F.when(
            F.col("spans").isNotNull(),
            F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), gone),
        ),
    )
    with_word = lambda a: F.size(F.filter(a, lambda x: F.regexp_like(x, F.lit(WORD))))
    kept = F.transform("kept_at", lambda i: F.element_at("all_lines", i + 1))
    return (
        split.withColumn("kept_lines", F.when(F.col("kept_at").isNotNull(), kept))
        .withColumn("lines", F.when(F.col("body").isNull(), 0).otherwise(with_word("all_lines")).cast("long"))
        .select(
            "doc",
            "lines",
            F.when(F.col("kept_at").isNull(), F.lit(0))
            .otherwise(F.col("lines") - with_word("kept_lines"))
            .cast("long")
            .alias("removed"),
            F.when(F.col("kept_at").isNull(), F.col("body"))
            .otherwise(F.array_join("kept_lines", "\n"))
            .alias("kept_text"),
        )
    )
