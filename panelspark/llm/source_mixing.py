"""Mixing sources to target weights by systematic sampling (native).

Every source gets a target number of words: its weight's share of all words,
at most ``max_copies`` times its own words, the excess shared anew by weight
among the others until no source is above. Within a source each document then
has the same expected number of copies r = target / source size. The documents
are laid out in an order that goes through the sizes from small to large; the
prefix sums of r plus one offset per source cut the line into unit steps, and a
document is emitted once for each integer boundary inside its interval, so
floor(r) or ceil(r) times. As the order follows the sizes, the words taken come
within about one document of the target.

The order of a source is cut into blocks (size class, hash digits), so that
a source with any share of the rows is ranked by many tasks: block counts give
the prefix sum before each block, a window inside the block gives the rest.

Defined results: a null text has size 0; a null source is a source of its own,
after all others; a source without words has target 0 and is taken 0 times;
equal rows are separate documents; an empty table gives an empty result.
Columns of the input are kept in one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import WORD

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Words per size class and number of size classes; the last one is open.
CLASS_WORDS, CLASSES = 32, 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source_key, source, source_size) -> the same with target and offset.

    One row per source comes in, so the two windows over all of them are small.
    The shares are those of a water level: sources are filled in the order of
    limit / weight, and the first one that the level does not exceed fixes it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_ratio", "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    everything = Window.partitionBy(F.lit(0))
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(max_copies))
        .withColumn("limit_ratio", F.col("limit").cast("double") / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("full_size", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("full_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("fill_order", F.row_number().over(by_limit))
        .withColumn(
            "level",
            (F.col("all_size") - F.col("full_size")).cast("double") / (F.col("all_weight") - F.col("full_weight")),
        )
    )
    reached = F.when(F.col("level") <= F.col("limit_ratio"), F.struct("fill_order", "level"))
    levelled = ranked.withColumn("at", F.min(reached).over(everything)["level"])
    return levelled.select(
        "source_key",
        "source",
        "source_size",
        F.least(F.col("limit").cast("double"), F.col("at") * F.col("weight")).alias("target"),
    )


def unit_offset(seed: str):
    """Offset in [0, 1) of a source: 32 bits of the md5 of seed and source."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("source_key")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_sources(
    docs: DataFrame,
    *,
    keep: Sequence[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = "mix",
    block_digits: int = 1,
) -> DataFrame:
    """(doc struct, size, source_size, target, copies) for every document.

    ``keep``: the input columns carried in ``doc`` (default: all).
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("doc"),
        F.col(id_col).alias("row_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")).alias("source_key"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("mark"),
    ).select(
        "*",
        F.least(F.floor(F.col("size") / CLASS_WORDS), F.lit(CLASSES - 1)).alias("size_class"),
        F.substring("mark", 1, block_digits).alias("slot"),
    )
    place = ["source_key", "size_class", "slot"]
    blocks = rows.groupBy(*place).agg(
        F.count("*").alias("block_rows"), F.sum("size").alias("block_size"), F.first("source").alias("source")
    )
    sources = blocks.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("block_size").alias("source_size")
    )
    targets = source_targets(sources, weights, max_copies).select(
        "source_key", "source_size", "target", unit_offset(seed).alias("shift")
    )
    earlier = Window.partitionBy("source_key").orderBy("size_class", "slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.withColumn("before", F.coalesce(F.sum("block_rows").over(earlier), F.lit(0)))
        .join(targets, "source_key")
        .select(*place, "before", "source_size", "target", "shift")
    )
    inside = Window.partitionBy(*place).orderBy("size", "mark", "row_id")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    end = F.floor(F.col("expected") * F.col("rank") + F.col("shift"))
    start = F.floor(F.col("expected") * (F.col("rank") - 1) + F.col("shift"))
    return (
        rows.join(starts, place)
        .withColumn("rank", F.col("before") + F.row_number().over(inside))
        .withColumn("expected", expected)
        .select("doc", "size", "source_size", "target", (end - start).alias("copies"))
    )


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document's columns, once per copy."""
    return mixed.where("copies > 0").select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).select("doc.*")
