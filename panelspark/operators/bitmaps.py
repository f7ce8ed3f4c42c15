"""Exact distinct counts from mergeable bitmaps.

``COUNT(DISTINCT CASE WHEN .. THEN id END)`` for several conditions makes Spark
copy every row once per count. Where the id is a whole number, a bitmap
per group has a bit for each id instead: all conditions are gathered in one
aggregation, without copies, and bitmaps of parts (days) merge into those of any
larger part (weeks, overlapping windows, everything), which distinct counts do not.

An id belongs to a bucket of 64 ids, whose bitmap is one number. Numbers are aggregated
in place, so the map side sums up without sorting, and a group takes memory only for buckets with
ids in them. Rows that meet no condition only keep their group: they all go into bucket 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str, conditions: Mapping[str, Column]) -> DataFrame:
    """(keys, bucket, a bitmap per condition): the ids of the rows for which it holds. NULL ids are in none."""
    at = F.col(id_col).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    known = df.where(F.col(id_col).isNotNull())
    met_any = F.coalesce(F.greatest(*[c.cast("boolean") for c in conditions.values()], F.lit(False)), F.lit(False))
    return known.groupBy(*keys, F.when(met_any, F.shiftright(at, 6)).otherwise(F.lit(0)).alias("bucket")).agg(
        *[F.coalesce(F.bit_or(F.when(met, bit)), F.lit(0)).alias(name) for name, met in conditions.items()]
    )


def merged(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The union of the bitmaps of each group of ``keys``, by bucket."""
    return bitmaps.groupBy(*keys, "bucket").agg(*[F.bit_or(n).alias(n) for n in names])


def distinct_ids(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, number of distinct ids per bitmap), merged over all other columns."""
    return merged(bitmaps, keys, names).groupBy(*keys).agg(*[F.sum(F.bit_count(n)).alias(n) for n in names])


def trailing_days(bitmaps: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Each day's bitmaps once for every day of the ``days`` long window they are in.

    Followed by ``distinct_ids`` by day it counts distinct ids over overlapping windows, which a
    window function cannot; the rows are days and buckets, not facts."""
    return bitmaps.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(days - 1)))).withColumn(
        date, F.date_add(date, F.col("_ahead"))
    ).drop("_ahead")
