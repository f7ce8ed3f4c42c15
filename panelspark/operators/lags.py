"""Correlation of two columns of a series at every lag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.ratios import correlation


def lag_correlations(
    df: DataFrame, cause: str, effect: str, max_lag: int, entity: str = "location", date: str = "date"
) -> DataFrame:
    """(entity, lag, pairs, correlation): ``effect`` with ``cause`` of ``lag`` rows before, for all lags up to ``max_lag``.

    One window gathers the last ``max_lag + 1`` values of ``cause`` as an array beside each row;
    the pairs of all lags come out of it and are summed up on the map side, so
    what is shuffled after the window is a row per entity and lag. Pairs with a NULL on either
    side do not count; a correlation without variance is NULL.
    """
    frame = Window.partitionBy(entity).orderBy(date).rowsBetween(-max_lag, 0)
    shifted = df.select(
        entity, F.col(effect).alias("_effect"), F.reverse(F.collect_list(F.struct(F.col(cause).alias("v"))).over(frame)).alias("_causes")
    )
    pairs = shifted.select(entity, "_effect", F.posexplode("_causes").alias("lag", "_cause"))
    return (
        pairs.where(F.col("_effect").isNotNull() & F.col("_cause.v").isNotNull())
        .groupBy(entity, "lag")
        .agg(
            F.count(F.lit(1)).alias("pairs"),
            correlation("_effect", "_cause.v").alias("correlation"),
        )
    )


def best_lag(correlations: DataFrame, min_pairs: int, places: int = 6, entity: str = "location") -> DataFrame:
    """(entity, best_lag, best_correlation, correlation_at_0, lags): the lag with the highest correlation.

    Correlations are rounded to ``places`` before they are compared, ties go to the shorter lag. Lags with less than
    ``min_pairs`` pairs, or without a correlation, do not take part."""
    rounded = F.round("correlation", places)
    return (
        correlations.where((F.col("pairs") >= min_pairs) & rounded.isNotNull() & ~F.isnan(rounded))
        .groupBy(entity)
        .agg(
            F.max(F.struct(rounded.alias("c"), (-F.col("lag")).alias("l"))).alias("_best"),
            F.max(F.when(F.col("lag") == 0, rounded)).alias("correlation_at_0"),
            F.count(F.lit(1)).alias("lags"),
        )
        .select(
            entity, (-F.col("_best.l")).alias("best_lag"), F.col("_best.c").alias("best_correlation"),
            "correlation_at_0", "lags",
        )
    )
