"""Coverage jobs, alone and joined with the outcomes panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import bands
from panelspark.functions.ratios import correlation, mean_of_decimals, mean_of_rounded, pct_ratio
from panelspark.operators.joins import panel_join
from panelspark.operators.latest import latest_per_entity, rows_at_entity_latest
from panelspark.operators.milestones import crossings, pivot_dates
from panelspark.operators.profile import two_level_profile
from panelspark.operators.ranking import top_k
from panelspark.operators.rolling import rolling
from panelspark.plans.exploration import grouped_rows
from panelspark.spec import DEFAULT, PanelSpec

COVERAGE = "people_fully_vaccinated_per_hundred"


def latest_coverage(vax: DataFrame, k: int = 30, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Each entity's latest row with a reported total, four coverage rates;
    the ``k`` entities with the highest fully-vaccinated rate."""
    pop = "population"
    rows = grouped_rows(vax, spec).where(F.col("total_vaccinations").isNotNull())
    latest = latest_per_entity(rows, spec.entity, spec.date).select(
        spec.entity,
        spec.group,
        pop,
        "total_vaccinations",
        "people_vaccinated",
        "people_fully_vaccinated",
        "total_boosters",
        pct_ratio("total_vaccinations", pop, 2).alias("total_vaccination_rate"),
        pct_ratio("people_vaccinated", pop, 2).alias("people_vaccinated_rate"),
        pct_ratio("people_fully_vaccinated", pop, 2).alias("fully_vaccinated_rate"),
        pct_ratio("total_boosters", pop, 2).alias("booster_rate"),
    )
    return top_k(latest, k, [F.col("fully_vaccinated_rate").desc_nulls_last(), F.col(spec.entity)])


def phase_effectiveness(
    vax: DataFrame,
    deaths: DataFrame,
    min_rows: int = 7,
    banding: bands.Banding = bands.VACCINATION_PHASES,
    by_days: bool = False,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Join the panels, band coverage into phases, smooth cases and deaths
    with 7-row means (7-day means with ``by_days``); per (entity, phase) with
    more than ``min_rows`` rows, then per phase.

    Both sides are filtered before the join; how to join is left to Spark.
    """
    e, d = spec.entity, spec.date
    v = grouped_rows(vax, spec).where(F.col(COVERAGE).isNotNull()).select(e, spec.group, d, COVERAGE)
    o = (
        grouped_rows(deaths, spec)
        .where(F.col("new_cases").isNotNull() & F.col("new_deaths").isNotNull())
        .select(e, d, "new_cases", "new_deaths")
    )
    rows = panel_join(v, o, (e, d)).select(
        e,
        COVERAGE,
        "new_cases",
        "new_deaths",
        banding.label(COVERAGE).alias("vaccination_phase"),
        rolling("new_cases", -6, 0, "avg", e, d, by_days).alias("cases_7day_avg"),
        rolling("new_deaths", -6, 0, "avg", e, d, by_days).alias("deaths_7day_avg"),
    )
    return two_level_profile(
        rows,
        "vaccination_phase",
        stage1=[
            F.round(F.avg("cases_7day_avg"), 0).alias("avg_daily_cases"),
            F.round(F.avg("deaths_7day_avg"), 0).alias("avg_daily_deaths"),
            F.round(F.avg(COVERAGE), 1).alias("avg_vaccination_rate"),
            F.sum("new_cases").alias("total_cases_in_phase"),
            F.sum("new_deaths").alias("total_deaths_in_phase"),
        ],
        stage2=[
            F.count_distinct(e).alias("countries_count"),
            mean_of_rounded("avg_daily_cases", 0).alias("avg_daily_cases"),
            mean_of_rounded("avg_daily_deaths", 0).alias("avg_daily_deaths"),
            mean_of_rounded("avg_vaccination_rate", 1).alias("avg_vaccination_rate"),
            F.sum("total_cases_in_phase").alias("total_cases"),
            F.sum("total_deaths_in_phase").alias("total_deaths"),
        ],
        min_rows=min_rows,
        entity_keys=(e,),
    ).orderBy(banding.ordinal("vaccination_phase"))


# (milestone label, output column) for each coverage threshold
MILESTONE_COLUMNS = tuple((label, f"reached_{threshold}_percent") for threshold, label in bands.MILESTONES)


def milestone_timeline(
    vax: DataFrame, k: int = 30, crossing: str = "last", spec: PanelSpec = DEFAULT
) -> DataFrame:
    """The date each entity crossed 10/30/50/70 % coverage and the days
    between milestones; entities that reached 10 % and 30 %, earliest first.

    A crossing needs the previous reported row below the threshold. If an
    entity crosses the same threshold twice, ``crossing="last"`` (the original
    analysis) reports the later date and ``crossing="first"`` the earlier one.
    """
    e, d = spec.entity, spec.date
    rows = grouped_rows(vax, spec).where(F.col(COVERAGE).isNotNull()).select(e, spec.group, d, COVERAGE)
    marked = crossings(rows, COVERAGE, bands.MILESTONES, e, d).where(F.col("milestone_reached").isNotNull())
    dates = pivot_dates(marked, (e, spec.group), "milestone_reached", d, MILESTONE_COLUMNS, pick=crossing)
    r10, r30, r50, r70 = (F.col(c) for _, c in MILESTONE_COLUMNS)
    timeline = dates.where(r10.isNotNull() & r30.isNotNull()).select(
        e,
        spec.group,
        "reached_10_percent",
        "reached_30_percent",
        "reached_50_percent",
        "reached_70_percent",
        F.date_diff(r30, r10).cast("long").alias("days_10_to_30_percent"),
        F.date_diff(r50, r30).cast("long").alias("days_30_to_50_percent"),
        F.date_diff(r70, r50).cast("long").alias("days_50_to_70_percent"),
    )
    return top_k(timeline, k, [r10.asc_nulls_first(), F.col(e), F.col(spec.group)])


def level_outcomes(
    vax: DataFrame,
    deaths: DataFrame,
    min_rows: int = 14,
    banding: bands.Banding = bands.VACCINATION_LEVELS,
    by_days: bool = False,
    with_corr: bool = False,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Join the panels, band coverage into levels, smooth the death rate
    per million with a 14-row mean (14-day mean with ``by_days``); per
    (entity, level) with more than ``min_rows`` rows, then per level.

    ``with_corr`` adds the mean over entities of the Pearson correlation of
    coverage and the smoothed death rate inside the level."""
    cell_corr = [F.round(correlation(COVERAGE, "deaths_14day_avg"), 3).alias("coverage_deaths_corr")] if with_corr else []
    level_corr = [F.round(F.avg("coverage_deaths_corr"), 3).alias("avg_coverage_deaths_corr")] if with_corr else []
    e, d = spec.entity, spec.date
    cov = F.col(COVERAGE)
    v = grouped_rows(vax, spec).where(cov.isNotNull() & (cov > 0)).select(e, d, COVERAGE)
    o = (
        grouped_rows(deaths, spec)
        .where(F.col("new_deaths_per_million").isNotNull())
        .select(e, d, "new_deaths_per_million")
    )
    rows = panel_join(v, o, (e, d)).select(
        e,
        COVERAGE,
        banding.label(COVERAGE).alias("vaccination_level"),
        rolling("new_deaths_per_million", -13, 0, "avg", e, d, by_days).alias("deaths_14day_avg"),
    )
    return two_level_profile(
        rows,
        "vaccination_level",
        stage1=[
            F.round(F.avg(COVERAGE), 1).alias("avg_vaccination_rate"),
            F.round(F.avg("deaths_14day_avg"), 1).alias("avg_death_rate"),
            F.round(F.max(COVERAGE), 1).alias("max_vaccination_rate"),
            F.round(F.min("deaths_14day_avg"), 1).alias("min_death_rate"),
            F.round(F.max("deaths_14day_avg"), 1).alias("max_death_rate"),
            *cell_corr,
        ],
        stage2=[
            F.count_distinct(e).alias("countries_count"),
            mean_of_rounded("avg_vaccination_rate", 1).alias("avg_vaccination_rate"),
            mean_of_rounded("avg_death_rate", 1).alias("avg_death_rate"),
            mean_of_rounded("max_vaccination_rate", 1).alias("avg_max_vaccination"),
            mean_of_rounded("min_death_rate", 1).alias("avg_min_death_rate"),
            mean_of_rounded("max_death_rate", 1).alias("avg_max_death_rate"),
            *level_corr,
        ],
        min_rows=min_rows,
        entity_keys=(e,),
    ).orderBy(banding.ordinal("vaccination_level"))


def booster_outcomes(
    vax: DataFrame,
    deaths: DataFrame,
    min_rows: int = 7,
    banding: bands.Banding = bands.BOOSTER_LEVELS,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Join the panels, band booster coverage into levels and compute the
    booster uptake; per (entity, group, level) with more than ``min_rows``
    rows, then per level. A NULL booster coverage falls in the lowest level.
    """
    e, d = spec.entity, spec.date
    pfv = F.col("people_fully_vaccinated")
    v = (
        grouped_rows(vax, spec)
        .where(F.col("total_boosters").isNotNull() & pfv.isNotNull() & (pfv > 0))
        .select(e, spec.group, d, "total_boosters", "total_boosters_per_hundred", "people_fully_vaccinated")
    )
    o = grouped_rows(deaths, spec).select(e, d, "new_cases", "new_deaths")
    rows = panel_join(v, o, (e, d)).select(
        e,
        spec.group,
        "total_boosters_per_hundred",
        "new_cases",
        "new_deaths",
        banding.label("total_boosters_per_hundred").alias("booster_level"),
        pct_ratio("total_boosters", "people_fully_vaccinated", 2).alias("booster_uptake_rate"),
    )
    return two_level_profile(
        rows,
        "booster_level",
        stage1=[
            F.round(F.avg("total_boosters_per_hundred"), 1).alias("avg_booster_rate"),
            F.round(F.avg("booster_uptake_rate"), 1).alias("avg_booster_uptake"),
            F.round(F.avg("new_cases"), 0).alias("avg_daily_cases"),
            F.round(F.avg("new_deaths"), 0).alias("avg_daily_deaths"),
        ],
        stage2=[
            F.count_distinct(e).alias("countries_count"),
            mean_of_rounded("avg_booster_rate", 1).alias("avg_booster_rate"),
            mean_of_rounded("avg_booster_uptake", 1).alias("avg_booster_uptake"),
            mean_of_rounded("avg_daily_cases", 0).alias("avg_daily_cases"),
            mean_of_rounded("avg_daily_deaths", 0).alias("avg_daily_deaths"),
        ],
        min_rows=min_rows,
        entity_keys=(e, spec.group),
    ).orderBy(banding.ordinal("booster_level"))


def inequality(
    vax: DataFrame,
    ddof: int = 0,
    banding: bands.Banding = bands.DEVELOPMENT_LEVELS,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Each entity's latest row with coverage reported, banded by
    development index; coverage statistics per (group, band).

    The latest date is taken per entity over all rows with coverage reported
    (``rank() = 1`` by date, one pass); rows at that date are then kept
    only if the group and the index are present. ``countries_count`` counts
    rows, which equals entities when the panel key is unique.
    """
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    hdi = F.col("human_development_index")
    rows = (
        rows_at_entity_latest(vax, spec.entity, spec.date, F.col(COVERAGE).isNotNull())
        .where(F.col(spec.group).isNotNull() & hdi.isNotNull())
        .withColumn("development_level", banding.label(hdi))
    )
    return (
        rows.groupBy(spec.group, "development_level")
        .agg(
            F.count(F.lit(1)).alias("countries_count"),
            F.round(F.avg(COVERAGE), 1).alias("avg_vaccination_rate"),
            F.round(F.min(COVERAGE), 1).alias("min_vaccination_rate"),
            F.round(F.max(COVERAGE), 1).alias("max_vaccination_rate"),
            F.round(std(COVERAGE), 1).alias("vaccination_std_dev"),
            F.round(F.avg("gdp_per_capita"), 0).alias("avg_gdp_per_capita"),
            mean_of_decimals(hdi, 3).alias("avg_hdi"),
        )
        .orderBy(F.col(spec.group), banding.ordinal("development_level"))
    )
