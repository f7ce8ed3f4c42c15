"""Trend, ranking, peak, phase and lag jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import bands
from panelspark.functions.ratios import correlation, growth_pct, mean_of_rounded, pct_ratio
from panelspark.operators.latest import aggregate_latest
from panelspark.operators.ranking import best_rows, positions_of, top_k
from panelspark.operators.rolling import rolling, shifted
from panelspark.plans.exploration import grouped_rows
from panelspark.spec import DEFAULT, PanelSpec


def global_trend(
    deaths: DataFrame,
    start_date: str = "2020-03-01",
    k: int = 30,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Daily global sums, 7-row means, global rates and day-over-day growth;
    the latest ``k`` days on or after ``start_date``.

    Days whose summed new cases are NULL are dropped before the windows; the
    start-date filter applies after them. The windows have no partition key:
    they run after the roll-up to one row per date, so their single task holds
    at most one row per calendar day whatever the size of the panel.
    """
    d = spec.date
    daily = (
        grouped_rows(deaths, spec)
        .groupBy(d)
        .agg(
            F.sum("new_cases").alias("global_new_cases"),
            F.sum("new_deaths").alias("global_new_deaths"),
            F.sum("total_cases").alias("global_total_cases"),
            F.sum("total_deaths").alias("global_total_deaths"),
            F.sum("population").alias("global_population"),
        )
        .where(F.col("global_new_cases").isNotNull())
    )
    series = Window.orderBy(d)
    last7 = series.rowsBetween(-6, 0)
    trend = daily.select(
        d,
        "global_new_cases",
        F.round(F.avg("global_new_cases").over(last7), 0).alias("cases_7day_avg"),
        "global_new_deaths",
        F.round(F.avg("global_new_deaths").over(last7), 0).alias("deaths_7day_avg"),
        pct_ratio("global_total_cases", "global_population", 2).alias("infection_rate_percent"),
        pct_ratio("global_total_deaths", "global_total_cases", 2).alias("case_fatality_rate_percent"),
        growth_pct("global_total_cases", F.lag("global_total_cases", 1).over(series), 2)
        .alias("daily_growth_rate_percent"),
    )
    return top_k(trend.where(F.col(d) >= F.lit(start_date).cast("date")), k, [F.col(d).desc()])


_RANKINGS = (
    ("rank_by_total_cases", "_cases"),
    ("rank_by_total_deaths", "_deaths"),
    ("rank_by_infection_rate", "_infection"),
    ("rank_by_death_rate", "_death"),
    ("rank_by_fatality_rate", "_fatality"),
)


def entity_rankings(deaths: DataFrame, k: int = 20, spec: PanelSpec = DEFAULT) -> DataFrame:
    """At the table's latest date, three rates and five global rankings of
    the entities with positive cases and deaths; keep the entities in the top
    ``k`` by cases or by deaths.

    Rankings use the unrounded values, descending, ties broken by entity name.
    One pass over the panel keeps each entity's last row; numbers and a date are all that it
    aggregates, so no task sorts the panel for it (it would, for a struct or a string). The entities that
    have one on the table's last day are chosen from and ranked: only the at most 2 ``k``
    of the result need their positions, which a histogram of ranges gives
    (``positions_of``); no task sorts all entities.
    """
    measures = ("population", "total_cases", "total_deaths")
    back = -F.unix_date(spec.date)
    last = (
        deaths.where(F.col(spec.group).isNotNull())
        .groupBy(spec.entity, spec.group)
        .agg(F.max(spec.date).alias(spec.date), *[F.min_by(m, back).alias(m) for m in measures])
        .groupBy(spec.entity)
        .agg(F.max_by(F.struct(spec.date, spec.group, *measures), spec.date).alias("_last"))
        .select(spec.entity, "_last.*")
    )
    counted = F.coalesce((F.col("total_cases") > 0) & (F.col("total_deaths") > 0), F.lit(False))

    def ranked(value: Column, name: str) -> Column:
        """Entities without a row on the last day, or without cases and deaths, come behind all others."""
        return F.struct(spec.date, counted.alias("counted"), value.alias("value")).alias(name)

    rated = last.select(
        *last.columns,
        ranked(F.col("total_cases"), "_cases"),
        ranked(F.col("total_deaths"), "_deaths"),
        ranked(pct_ratio("total_cases", "population"), "_infection"),
        ranked(pct_ratio("total_deaths", "population"), "_death"),
        ranked(pct_ratio("total_deaths", "total_cases"), "_fatality"),
    )
    best = best_rows(rated, k, spec.entity, ("_cases", "_deaths"))
    newest = F.max(spec.date).over(Window.partitionBy(F.lit(0)))  # of the at most 2 k best rows
    chosen = best.withColumn("_newest", newest).where((F.col(spec.date) == F.col("_newest")) & F.col("_cases.counted"))
    return (
        positions_of(chosen, rated, spec.entity, _RANKINGS)
        .select(
            spec.entity,
            spec.group,
            "population",
            "total_cases",
            "total_deaths",
            pct_ratio("total_cases", "population", 2).alias("infection_rate_percent"),
            pct_ratio("total_deaths", "population", 2).alias("death_rate_percent"),
            pct_ratio("total_deaths", "total_cases", 2).alias("case_fatality_rate_percent"),
            *[name for name, _ in _RANKINGS],
        )
        .orderBy("rank_by_total_cases")
    )


def group_percentiles(deaths: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per group at the latest date, mean rates and sums, and the percent
    rank of each rounded mean rate among all groups (x100, one decimal).

    The percent ranks run on one row per group (bounded by the group count).
    """
    seen = F.col("total_cases") > 0
    among = lambda c: F.when(seen, c)
    stats = aggregate_latest(
        grouped_rows(deaths, spec),
        [
            F.round(F.avg(among(pct_ratio("total_cases", "population"))), 2).alias("avg_infection_rate"),
            F.round(F.avg(among(pct_ratio("total_deaths", "population"))), 2).alias("avg_death_rate"),
            F.round(F.avg(among(pct_ratio("total_deaths", "total_cases"))), 2).alias("avg_fatality_rate"),
            F.sum(among(F.col("total_cases"))).alias("total_cases_sum"),
            F.sum(among(F.col("total_deaths"))).alias("total_deaths_sum"),
            F.sum(among(F.col("population"))).alias("total_population"),
        ],
        by=[spec.group],
        date=spec.date,
        distinct=("countries_count", among(F.col(spec.entity))),
    ).where("countries_count > 0")

    def pct_rank(col: str):
        return F.round(F.percent_rank().over(Window.orderBy(F.col(col).asc_nulls_first())) * 100, 1)

    return stats.select(
        "*",
        pct_rank("avg_infection_rate").alias("infection_rate_percentile"),
        pct_rank("avg_death_rate").alias("death_rate_percentile"),
        pct_rank("avg_fatality_rate").alias("fatality_rate_percentile"),
    ).orderBy(F.col("total_deaths_sum").desc())


def peak_days(deaths: DataFrame, k: int = 20, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Each entity's peak day(s) of new cases or new deaths, with peak
    flags and both per-entity ranks; the ``k`` rows with most cases.

    Ties at the peak keep every tied day. Both ranks share one shuffle on the
    entity; a partition holds one entity's series (at most one row per day).
    """
    e = spec.entity
    nc, nd = F.col("new_cases"), F.col("new_deaths")
    whole = Window.partitionBy(e)
    peaks = (
        grouped_rows(deaths, spec)
        .where(nc.isNotNull() & nd.isNotNull() & (nc > 0) & (nd > 0))
        .select(
            e,
            spec.date,
            "new_cases",
            "new_deaths",
            F.when(nc == F.max(nc).over(whole), F.lit(bands.PEAK_CASES))
            .otherwise(F.lit(bands.NOT_PEAK))
            .alias("case_peak_status"),
            F.when(nd == F.max(nd).over(whole), F.lit(bands.PEAK_DEATHS))
            .otherwise(F.lit(bands.NOT_PEAK))
            .alias("death_peak_status"),
            F.rank().over(Window.partitionBy(e).orderBy(nc.desc())).cast("long").alias("case_rank"),
            F.rank().over(Window.partitionBy(e).orderBy(nd.desc())).cast("long").alias("death_rank"),
        )
        .where((F.col("case_rank") == 1) | (F.col("death_rank") == 1))
    )
    return top_k(peaks, k, [nc.desc(), F.col(e), F.col(spec.date)])


def entity_phase_spans(
    deaths: DataFrame, banding: bands.Banding = bands.GROWTH_PHASES, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Per entity and growth phase: days in the phase, first and last date,
    maximum cumulative cases and deaths, and the days from the entity's first
    case to the phase start (J13 stage 2, kept as its own result)."""
    e = spec.entity
    spans = (
        grouped_rows(deaths, spec)
        .where(F.col("total_cases") > 0)
        .withColumn("growth_phase", banding.label("total_cases"))
        .groupBy(e, "growth_phase")
        .agg(
            F.count(F.lit(1)).alias("days_in_phase"),
            F.min(spec.date).alias("phase_start_date"),
            F.max(spec.date).alias("phase_end_date"),
            F.max("total_cases").alias("max_cases_in_phase"),
            F.max("total_deaths").alias("max_deaths_in_phase"),
        )
    )
    first_case = F.min("phase_start_date").over(Window.partitionBy(e))
    return spans.withColumn(
        "days_since_first_case", F.date_diff("phase_start_date", first_case).cast("long")
    )


def growth_phases(
    deaths: DataFrame, banding: bands.Banding = bands.GROWTH_PHASES, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Per growth phase, number of entities, mean days in the phase and
    mean of the per-entity maxima, in phase order."""
    spans = entity_phase_spans(deaths, banding, spec).drop("days_since_first_case")
    return (
        spans.groupBy("growth_phase")
        .agg(
            F.count_distinct(spec.entity).alias("countries_count"),
            mean_of_rounded("days_in_phase", 1).alias("avg_days_in_phase"),
            mean_of_rounded("max_cases_in_phase", 0).alias("avg_max_cases"),
            mean_of_rounded("max_deaths_in_phase", 0).alias("avg_max_deaths"),
        )
        .orderBy(banding.ordinal("growth_phase"))
    )


def lagged_association(
    deaths: DataFrame,
    shift: int = 14,
    min_points: int = 30,
    k: int = 20,
    direction: str = "lag",
    with_corr: bool = False,
    by_days: bool = False,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Per entity, means of daily cases and deaths, of deaths shifted by
    ``shift`` rows and of the 7-row means; entities with more than
    ``min_points`` rows that have a shifted value; the ``k`` with most cases.

    ``direction="lag"`` reproduces the source analysis, whose
    "deaths 14 days later" column is the value 14 rows *earlier*;
    ``direction="lead"`` takes the value 14 rows later. ``with_corr`` adds the
    Pearson correlation of daily cases with the shifted deaths. ``by_days``
    makes the 7-row means 7-day means (the shift stays a row offset).
    """
    e, d = spec.entity, spec.date
    nc, nd = F.col("new_cases"), F.col("new_deaths")
    offset = shift if direction == "lag" else -shift
    rows = (
        grouped_rows(deaths, spec)
        .where(nc.isNotNull() & nd.isNotNull() & (nc > 0) & (nd > 0))
        .select(
            e,
            "new_cases",
            "new_deaths",
            shifted("new_deaths", offset, e, d).alias("_shifted"),
            rolling("new_cases", -6, 0, "avg", e, d, by_days).alias("_c7"),
            rolling("new_deaths", -6, 0, "avg", e, d, by_days).alias("_d7"),
        )
        .where(F.col("_shifted").isNotNull())
    )
    aggs = [
        F.count(F.lit(1)).alias("data_points"),
        F.round(F.avg("new_cases"), 0).alias("avg_daily_cases"),
        F.round(F.avg("new_deaths"), 0).alias("avg_daily_deaths"),
        F.round(F.avg("_shifted"), 0).alias("avg_deaths_14_days_later"),
        F.round(F.avg("_c7"), 0).alias("avg_7day_cases"),
        F.round(F.avg("_d7"), 0).alias("avg_7day_deaths"),
    ]
    if with_corr:
        aggs.append(F.round(correlation(nc, "_shifted"), 3).alias("cases_deaths_corr"))
    per_entity = rows.groupBy(e).agg(*aggs).where(F.col("data_points") > min_points)
    return top_k(per_entity, k, [F.col("avg_daily_cases").desc(), F.col(e)])


__all__ = [
    "entity_phase_spans",
    "entity_rankings",
    "global_trend",
    "group_percentiles",
    "growth_phases",
    "lagged_association",
    "peak_days",
]
