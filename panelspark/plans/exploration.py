"""Profiling and data-quality jobs.

Every job takes the panel DataFrame(s) and returns a DataFrame; nothing is
collected. Rows with a NULL group are aggregate rows and are dropped first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import bands
from panelspark.functions.ratios import pct_ratio
from panelspark.operators.latest import aggregate_latest
from panelspark.operators.profiling import completeness, overview
from panelspark.operators.ranking import top_k
from panelspark.operators.rolling import rolling
from panelspark.spec import DEFAULT, PanelSpec


def grouped_rows(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Drop aggregate rows (NULL group); every job starts here."""
    return df.where(F.col(spec.group).isNotNull())


def dataset_overview(
    deaths: DataFrame,
    vax: DataFrame,
    names: Sequence[str] = bands.DATASET_NAMES,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Rows, distinct entities, distinct dates and date range of each panel."""
    return overview(grouped_rows(deaths, spec), names[0], spec.entity, spec.date).unionByName(
        overview(grouped_rows(vax, spec), names[1], spec.entity, spec.date)
    )


def column_completeness(
    deaths: DataFrame,
    vax: DataFrame,
    deaths_columns: Sequence[str] = ("total_cases", "total_deaths"),
    vax_columns: Sequence[str] = ("total_vaccinations", "people_fully_vaccinated"),
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Percent of non-NULL values per column, one scan per panel."""
    return (
        completeness(grouped_rows(deaths, spec), deaths_columns)
        .unionByName(completeness(grouped_rows(vax, spec), vax_columns))
        .orderBy(F.col("completeness_percentage").desc())
    )


def group_distribution(deaths: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per group, entities, rows, mean population and summed cumulative totals.

    As in the source analysis the mean population is weighted by row count and
    the cumulative columns are summed over all days.
    """
    return (
        grouped_rows(deaths, spec)
        .groupBy(spec.group)
        .agg(
            F.count_distinct(spec.entity).alias("countries_count"),
            F.count(F.lit(1)).alias("total_records"),
            F.round(F.avg("population"), 0).alias("avg_population"),
            F.sum("total_cases").alias("total_cases_sum"),
            F.sum("total_deaths").alias("total_deaths_sum"),
        )
        .orderBy(F.col("total_deaths_sum").desc())
    )


def group_value_stats(
    deaths: DataFrame, value: str = "population", ddof: int = 0, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Per group, distinct entities and min/max/mean/std of ``value``.

    ``ddof=0`` is the population standard deviation (what STDDEV means in the
    source dialect); ``ddof=1`` the sample one.
    """
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    return (
        grouped_rows(deaths, spec)
        .groupBy(spec.group)
        .agg(
            F.count_distinct(spec.entity).alias("countries"),
            F.min(value).alias("min_population"),
            F.max(value).alias("max_population"),
            F.round(F.avg(value), 0).alias("avg_population"),
            F.round(std(value), 0).alias("population_std_dev"),
        )
        .orderBy(F.col("avg_population").desc())
    )


def entity_coverage(
    deaths: DataFrame,
    min_rows: int = 100,
    k: int = 20,
    reported: str | None = None,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Per entity, first/last date, span in days and row count; entities
    with more than ``min_rows`` rows; the ``k`` longest spans.

    ``reported`` restricts the rows to those where that column is not NULL.
    Ties on the span are broken by entity name.
    """
    base = grouped_rows(deaths, spec)
    if reported:
        base = base.where(F.col(reported).isNotNull())
    per_entity = (
        base.groupBy(spec.entity)
        .agg(
            F.min(spec.date).alias("first_record_date"),
            F.max(spec.date).alias("last_record_date"),
            F.count(F.lit(1)).alias("total_days_with_data"),
        )
        .where(F.col("total_days_with_data") > min_rows)
        .select(
            spec.entity,
            "first_record_date",
            "last_record_date",
            F.date_diff("last_record_date", "first_record_date").cast("long").alias("days_span"),
            "total_days_with_data",
        )
    )
    return top_k(per_entity, k, [F.col("days_span").desc(), F.col(spec.entity)])


def rolling_outliers(
    deaths: DataFrame,
    value: str = "new_cases",
    k: int = 20,
    ddof: int = 0,
    side: str = "high",
    by_days: bool = False,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Rows whose value lies more than two standard deviations from the
    mean of the seven previous reported rows of the same entity (of the
    reported rows in the seven previous days with ``by_days``).

    Only positive reported values take part (filtered before the windows).
    ``side`` keeps high outliers (default), low ones, or both. The ``k``
    largest values are returned; ties broken by entity and date.
    """
    std = "stddev_pop" if ddof == 0 else "stddev_samp"
    v = F.col(value)
    avg7, std7 = F.col("_avg7"), F.col("_std7")
    high = v > avg7 + F.lit(2) * std7
    low = v < avg7 - F.lit(2) * std7
    keep = {"high": high, "low": low, "both": high | low}[side]
    flagged = (
        grouped_rows(deaths, spec)
        .where(v.isNotNull() & (v > 0))
        .select(
            spec.entity,
            spec.date,
            value,
            rolling(value, -7, -1, "avg", spec.entity, spec.date, by_days).alias("_avg7"),
            rolling(value, -7, -1, std, spec.entity, spec.date, by_days).alias("_std7"),
        )
        .where(keep)
        .select(
            spec.entity,
            spec.date,
            value,
            F.round(avg7, 0).alias("avg_7day_cases"),
            F.round(std7, 0).alias("std_7day_cases"),
            F.when(high, F.lit(bands.OUTLIER_HIGH))
            .when(low, F.lit(bands.OUTLIER_LOW))
            .otherwise(F.lit(bands.OUTLIER_NORMAL))
            .alias("outlier_status"),
        )
    )
    return top_k(flagged, k, [F.col(value).desc(), F.col(spec.entity), F.col(spec.date)])


def consistency_check(deaths: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Entities whose population or group takes more than one value."""
    n_pop, n_grp = F.col("unique_population_values"), F.col("unique_continent_values")
    return (
        grouped_rows(deaths, spec)
        .groupBy(spec.entity)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_distinct("population").alias("unique_population_values"),
            F.count_distinct(spec.group).alias("unique_continent_values"),
        )
        .where((n_pop > 1) | (n_grp > 1))
        .select(
            spec.entity,
            "total_records",
            "unique_population_values",
            F.when(n_pop > 1, F.lit(bands.POPULATION_VARIES))
            .otherwise(F.lit(bands.POPULATION_CONSISTENT))
            .alias("population_consistency"),
            "unique_continent_values",
            F.when(n_grp > 1, F.lit(bands.CONTINENT_VARIES))
            .otherwise(F.lit(bands.CONTINENT_CONSISTENT))
            .alias("continent_consistency"),
        )
        .orderBy(F.col("total_records").desc())
    )


def latest_summary(deaths: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Totals and global rates over the rows at the table's latest date.

    Summed per date in one pass; the last date is taken from the sums. The entities are counted
    by their own last dates, which the same pass takes."""
    totals = aggregate_latest(
        grouped_rows(deaths, spec),
        [
            F.sum("population").alias("p"),
            F.sum("total_cases").alias("c"),
            F.sum("total_deaths").alias("d"),
        ],
        date=spec.date,
        distinct=("n", F.col(spec.entity)),
    )
    return totals.select(
        F.lit(bands.GLOBAL_SUMMARY).alias("metric"),
        F.coalesce("n", F.lit(0).cast("long")).alias("total_countries"),
        F.col("p").alias("total_population"),
        F.col("c").alias("total_cases"),
        F.col("d").alias("total_deaths"),
        pct_ratio("c", "p", 2).alias("global_infection_rate_percent"),
        pct_ratio("d", "c", 2).alias("global_case_fatality_rate_percent"),
    )
