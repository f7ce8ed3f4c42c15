"""Threshold crossings and label-to-date pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.rolling import shifted


def crossings(
    df: DataFrame,
    value: str,
    thresholds: Sequence[tuple[float, str]],
    entity: str = "location",
    date: str = "date",
    name: str = "milestone_reached",
) -> DataFrame:
    """Label the rows where ``value`` crosses a threshold upward.

    A row crosses threshold t when ``value >= t`` and the previous row's value
    (in date order within the entity) is ``< t``. Arms are tested in the given
    order and the first match wins, so a jump over several thresholds in one
    step records only the first; the first row of a series (no previous row)
    never crosses. Non-crossing rows get NULL.

    The previous value is computed once and shared by every arm.
    """
    prev = F.col("_prev")
    cur = F.col(value)
    label = None
    for t, lab in thresholds:
        cond = (cur >= t) & (prev < t)
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
    return (
        df.withColumn("_prev", shifted(value, 1, entity, date))
        .withColumn(name, label)
        .drop("_prev")
    )


def pivot_dates(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    date: str,
    columns: Sequence[tuple[str, str]],
    pick: str = "last",
) -> DataFrame:
    """One row per ``keys`` with one date column per label.

    ``columns`` lists (label value, output column). Each output is the
    ``max`` (``pick="last"``) or ``min`` (``pick="first"``) date over the rows
    carrying that label. A plain grouped aggregate: partial aggregation on the
    map side, one row per key after the shuffle.
    """
    agg = {"last": F.max, "first": F.min}[pick]
    lab = F.col(label)
    return df.groupBy(*keys).agg(
        *[agg(F.when(lab == value, F.col(date))).alias(out) for value, out in columns]
    )
