"""Latest rows: at the table's latest date, or each entity's latest date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_global(df: DataFrame, date: str = "date", where: Column | None = None) -> DataFrame:
    """Rows matching ``where`` whose ``date`` equals the latest such date.

    Entities that did not report on that day are absent: "latest" is one date
    for the whole table, not per entity (see ``latest_per_entity``).

    The maximum is a scalar subquery over the date column. On a stored table
    the filter then reaches the scan, which prunes by date. Jobs that only need
    sums at the latest date take them per date instead, in one pass
    (``aggregate_latest``).
    """
    base = df if where is None else df.where(where)
    return base.where(F.col(date) == base.select(F.max(date)).scalar())


def aggregate_latest(
    df: DataFrame,
    aggregates: Sequence[Column],
    by: Sequence[str] = (),
    date: str = "date",
    distinct: tuple[str, Column] | None = None,
) -> DataFrame:
    """``aggregates`` over the rows at the table's latest date, per ``by``.

    One pass: the aggregates are taken per date (map-side combined), and of that
    small result the last date of each group is kept, if it is the last of all.
    Without ``by`` there is one row also for an empty input, as with any global aggregate.

    ``distinct`` (name, column) also counts the column's distinct values at that date. A distinct
    count per date would keep every value of every date apart. Each value's last date is enough, a
    row per value, and the same pass takes it (grouping sets).
    """
    if distinct is None:
        daily = df.groupBy(*by, date).agg(*aggregates)
    else:
        daily = _daily_with_distinct(df, aggregates, by, date, *distinct)
    names = daily.columns[len(by) + 1 :]
    last = daily.groupBy(*by).agg(F.max_by(F.struct(*names), date).alias("_at"), F.max(date).alias("_date"))
    if by:
        last = last.withColumn("_latest", F.max("_date").over(Window.partitionBy(F.lit(0))))
        last = last.where(F.col("_date") == F.col("_latest"))
    return last.select(*by, *[F.col(f"_at.{n}").alias(n) for n in names])


def _daily_with_distinct(
    df: DataFrame, aggregates: Sequence[Column], by: Sequence[str], date: str, name: str, value: Column
) -> DataFrame:
    """(by, date, ``name``, aggregates); ``name`` counts the values that are seen on that date for the last time."""
    rows = df.withColumn("_value", value)
    seen = F.when(F.col("_value").isNotNull(), F.col(date))
    both = rows.groupingSets([[*by, date], [*by, "_value"]], *by, date, "_value").agg(
        F.grouping(date).alias("_of_value"), F.max(seen).alias("_seen"), *aggregates
    )
    names = both.columns[len(by) + 4 :]
    of_value = F.col("_of_value") == 1
    return (
        both.withColumn("_day", F.when(of_value, F.col("_seen")).otherwise(F.col(date)))
        .groupBy(*by, "_day")
        .agg(
            F.count(F.when(of_value & F.col("_value").isNotNull(), True)).alias(name),
            F.first(F.when(~of_value, F.struct(*names)), ignorenulls=True).alias("_of_day"),
        )
        .select(*by, F.col("_day").alias(date), name, "_of_day.*")
    )


def latest_per_entity(
    df: DataFrame,
    entity: str = "location",
    date: str = "date",
    reported: Column | None = None,
) -> DataFrame:
    """Each entity's latest row among rows where ``reported`` holds.

    ``row_number() = 1`` over (entity, date DESC). Spark plans this with a
    WindowGroupLimit below and above the shuffle, so each map task forwards at
    most one row per entity; a hot entity costs no more than a cold one.
    One row per entity even if the key (entity, date) repeats.
    """
    base = df if reported is None else df.where(reported)
    w = Window.partitionBy(entity).orderBy(F.col(date).desc())
    return base.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def rows_at_entity_latest(
    df: DataFrame,
    entity: str = "location",
    date: str = "date",
    reported: Column | None = None,
) -> DataFrame:
    """Rows whose ``date`` equals their entity's latest date among rows where
    ``reported`` holds (the correlated ``date = (SELECT MAX(date) ... WHERE
    b.entity = a.entity AND reported)`` form). Keeps every row at that date.

    ``rank() = 1`` keeps all ties and plans a WindowGroupLimit below and above
    the shuffle: each map task forwards only its entities' last rows.
    """
    base = df if reported is None else df.where(reported)
    w = Window.partitionBy(entity).orderBy(F.col(date).desc())
    return base.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")
