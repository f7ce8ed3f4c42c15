"""Data-profiling operators: table overview and column completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.ratios import pct_ratio


def overview(df: DataFrame, name: str, entity: str = "location", date: str = "date") -> DataFrame:
    """One row: dataset name, rows, distinct entities, distinct dates, first and last date."""
    return df.agg(
        F.lit(name).alias("dataset_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(entity).alias("unique_countries"),
        F.count_distinct(date).alias("unique_dates"),
        F.min(date).alias("earliest_date"),
        F.max(date).alias("latest_date"),
    )


def completeness(df: DataFrame, columns: Sequence[str], places: int = 2) -> DataFrame:
    """Per column: total rows, non-NULL rows and percent complete.

    One aggregate over the table computes the counts of every column in a
    single scan, then ``unpivot`` turns the one wide row into one row per
    column (instead of one scan per column joined by UNION ALL).
    """
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(c).alias(c) for c in columns],
    )
    long = wide.unpivot("total_rows", list(columns), "column_name", "non_null_count")
    return long.select(
        "column_name",
        "total_rows",
        "non_null_count",
        pct_ratio("non_null_count", "total_rows", places).alias("completeness_percentage"),
    )
