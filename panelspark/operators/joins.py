"""Joining two panels: on their key, with a check of it, and as of a day."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("location", "date")) -> DataFrame:
    """Panel keys that occur more than once (empty when the key is unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def panel_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("location", "date"),
    how: str = "inner",
    co_partition_on: str | None = None,
) -> DataFrame:
    """Equi-join two panels on ``keys`` (one copy of each key column).

    By default Spark plans the join: it may broadcast a side, and AQE may split
    the partitions of a hot key. ``co_partition_on`` hash-partitions both sides
    on one key first, so that a per-entity window after the join needs no
    shuffle of its own (with ``spark.sql.requireAllClusterKeysForCoPartition``
    off); such a partitioning is never split, so it is for entities of even size.

    Duplicate keys fan out, as in SQL; where uniqueness matters use
    ``checked_panel_join``, or ``duplicate_keys`` on a side.
    """
    if co_partition_on:
        left = left.repartition(co_partition_on)
        right = right.repartition(co_partition_on)
    return left.join(right, list(keys), how)


class KeyCheck:
    """What a checked join has seen of its keys; filled when the join has run."""

    def __init__(self, sides: dict[str, Observation]):
        self._sides = sides

    def repeated_rows(self) -> dict[str, int]:
        """Rows of each side whose key occurs more than once."""
        return {side: int(seen.get["repeated"]) for side, seen in self._sides.items()}


def checked_panel_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("location", "date"),
    how: str = "inner",
    on_duplicates: str = "count",
) -> tuple[DataFrame, KeyCheck]:
    """``panel_join`` that checks in the same pass whether the keys are unique.

    Adds ``left_copies`` and ``right_copies``, the number of rows of the side that have the row's
    key. They are counted behind the shuffle that the join needs anyway, over the same
    partitioning and order, and each side's repeated rows are observed on the way
    (``KeyCheck``), matched or not: no side is read a second time.

    ``on_duplicates="fail"`` raises at the first repeated key instead of fanning out. A NULL key
    matches nothing, as in SQL, but is counted.
    """
    if on_duplicates not in ("count", "fail"):
        raise ValueError(f"on_duplicates is count or fail, not {on_duplicates!r}")
    seen = {side: Observation(f"{side}_{uuid.uuid4().hex}") for side in ("left", "right")}

    def checked(df: DataFrame, side: str) -> DataFrame:
        copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        if on_duplicates == "fail":
            message = F.concat(F.lit(f"repeated key in the {side} side: "), F.to_json(F.struct(*keys)))
            copies = F.when(copies > 1, F.raise_error(message).cast("long")).otherwise(copies)
        counted = df.withColumn(f"{side}_copies", copies)
        return counted.observe(seen[side], F.count_if(F.col(f"{side}_copies") > 1).alias("repeated"))

    return checked(left, "left").join(checked(right, "right"), list(keys), how), KeyCheck(seen)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("location",),
    on: str = "date",
    tolerance_days: int | None = None,
    span_days: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the latest row of ``right`` on or before its day.

    Adds ``matched_<on>``, that row's day. Both are NULL where there is none, or none within
    ``tolerance_days``, and for rows of ``left`` without a day or with a NULL in ``by``. Of several rows of a
    day the one with the largest (``columns``) counts.

    One shuffle: both tables are stacked, and the last row of ``right`` is
    carried down each series. A series then is one task; ``span_days`` cuts it into spans of
    that many days, which are tasks of their own, and carries a row per span from
    one to the next. Use it where series are long or one of them holds much of the data.
    """
    at, value, side, rank = "_at", "_value", "_side", "_span"
    width = span_days or 1
    day = F.unix_date(F.col(on).cast("date"))
    queries = left.withColumn("_left", F.struct(*[F.col(f"`{c}`") for c in left.columns])).select(
        *by, day.alias(at), F.lit(1).alias(side), "_left"
    )
    found = F.struct(F.col(on).alias(f"matched_{on}"), *columns)
    reports = right.where(F.col(on).isNotNull()).select(*by, day.alias(at), F.lit(0).alias(side), found.alias(value))
    both = queries.unionByName(reports, allowMissingColumns=True)
    series = [*by] if span_days is None else [*by, rank]
    both = both.withColumn(rank, F.floor(F.col(at) / width)) if span_days else both
    so_far = Window.partitionBy(*series).orderBy(at, side, value).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_match", F.last(value, ignorenulls=True).over(so_far))
    if span_days:
        last = both.groupBy(*series).agg(F.max(F.when(F.col(value).isNotNull(), F.struct(at, value))).alias("_last"))
        before = Window.partitionBy(*by).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
        handed = last.select(*series, F.last("_last", ignorenulls=True).over(before)[value].alias("_handed"))
        # few rows a series; spans are matched with nulls equal, as groups are
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in series]
        joined = carried.alias("a").join(handed.alias("b"), reduce(lambda x, y: x & y, same), "left")
        carried = joined.select("a.*", F.coalesce("a._match", "b._handed").alias("_found")).drop("_match")
        carried = carried.withColumnRenamed("_found", "_match")
    known = F.col(at).isNotNull() & reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in by])
    if tolerance_days is not None:
        known = known & (F.col(at) - F.unix_date(F.col(f"_match.matched_{on}").cast("date")) <= tolerance_days)
    kept = carried.where(F.col(side) == 1)
    return kept.select("_left.*", *[F.when(known, F.col(f"_match.{c}")).alias(c) for c in (f"matched_{on}", *columns)])
