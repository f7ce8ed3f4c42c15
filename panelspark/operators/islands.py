"""Unbroken runs of days (gaps and islands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(
    df: DataFrame, aggregates: Sequence[Column] = (), entity: str = "location", date: str = "date"
) -> DataFrame:
    """One row per entity and unbroken run of days: ``run_start``, ``run_end``, ``days``,
    ``gap_before`` (days without a row since the run before, NULL for the first) and ``aggregates``.

    Days less their number in the series are the same for all days of a run, so a run is a
    group. Several rows of a day count as one day of the run, and all go into the
    aggregates. Rows without a day are left out.

    The gap is known at a run's first row, so the rows are sorted once. They go into as many tasks as
    the session's shuffles have partitions, none of them merged: what is small as
    compressed shuffle data is much more in the sort and the aggregation of a task.
    """
    series = Window.partitionBy(entity).orderBy(date)
    island = F.unix_date(F.col(date)) - F.dense_rank().over(series)
    gap = F.date_diff(F.col(date), F.lag(date).over(series)) - 1
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        df.where(F.col(date).isNotNull())
        .repartition(tasks, entity)
        .withColumn("_island", island)
        .withColumn("_gap", F.when(gap > 0, gap))
        .groupBy(entity, "_island")
        .agg(
            F.min(date).alias("run_start"), F.max(date).alias("run_end"),
            F.max("_gap").cast("long").alias("gap_before"), *aggregates,
        )
    )
    names = found.columns[5:]
    return found.select(
        entity, "run_start", "run_end",
        (F.date_diff("run_end", "run_start") + 1).cast("long").alias("days"),
        "gap_before",
        *names,
    )
