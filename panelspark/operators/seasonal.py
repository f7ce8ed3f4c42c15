"""Trend and seasonal indices of daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def centred_mean(value: str, half: int, entity: str = "location", date: str = "date") -> Column:
    """Mean of ``value`` from ``half`` rows before to ``half`` rows after; NULL at the ends of the series.

    From running totals, so its cost does not depend on the width; NULL values count as zero."""
    series = Window.partitionBy(entity).orderBy(date)
    up_to = series.rowsBetween(Window.unboundedPreceding, half)
    before = series.rowsBetween(Window.unboundedPreceding, -half - 1)
    known = F.coalesce(F.col(value), F.lit(0))
    total = F.sum(known).over(up_to) - F.coalesce(F.sum(known).over(before), F.lit(0))
    rows = F.count(F.lit(1)).over(up_to) - F.count(F.lit(1)).over(before)
    return F.when(rows == 2 * half + 1, total / F.lit(2 * half + 1))


def seasonal_indices(
    df: DataFrame, value: str, periods: dict[str, tuple[Column, int]], entity: str = "location", date: str = "date"
) -> DataFrame:
    """Seasonal indices of dense daily series: (entity, pattern, position, days, seasonal_index).

    ``periods`` names the patterns: the position of a day in it (weekday, month) and half
    the width of the trend that goes with it. The ratio of each day's value to its trend is averaged by
    position, and the averages of an entity are scaled to a mean of one. Days without a whole
    trend window, or with a trend of zero, are left out; NULL values count as zero.

    All trends are windows over one partitioning and order of the series.
    """
    ratios = df.select(
        entity,
        *[
            F.struct(
                position.cast("int").alias("position"),
                F.try_divide(F.coalesce(F.col(value), F.lit(0)).cast("double"), centred_mean(value, half, entity, date))
                .alias("ratio"),
            ).alias(name)
            for name, (position, half) in periods.items()
        ],
    )
    each = F.array(*[F.struct(F.lit(name).alias("pattern"), F.col(name).alias("at")) for name in periods])
    mean = (
        ratios.select(entity, F.explode(each).alias("p"))
        .where(F.col("p.at.ratio").isNotNull())
        .groupBy(entity, F.col("p.pattern").alias("pattern"), F.col("p.at.position").alias("position"))
        .agg(F.count(F.lit(1)).alias("days"), F.avg("p.at.ratio").alias("mean"))
    )
    scale = F.avg("mean").over(Window.partitionBy(entity, "pattern"))
    return mean.select(
        entity, "pattern", "position", "days", F.try_divide(F.col("mean"), scale).alias("seasonal_index")
    )
