"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, root)`` where ``root`` holds the base-table
parquet files, derives the panels from those tables and returns the job's
DataFrame without collecting it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelspark.oracle import jobs_sql as J
from panelspark.oracle.panels_sql import with_panels
from panelspark.plans import exploration as ex
from panelspark.plans import global_analysis as ga
from panelspark.plans import vaccination as vx
from panelspark.sources.panels import deaths_panel, vax_panel
from panelspark.sources.tables import Tables

Builder = Callable[[SparkSession, str], DataFrame]

# The test tables span 1995-2001; the source analysis starts its trend report
# at 2020-03-01, which is a parameter here.
TREND_START = "1996-03-01"


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    kind: str  # "job", "operator", "primitive" or "source"
    grain: str = "nation"  # entity grain of the derived panels (see sources.panels)

    def oracle(self) -> str | None:
        return None if self.sql is None else with_panels(self.sql, self.grain)


def _deaths(fn, grain="nation", **kw) -> Builder:
    return lambda spark, root: fn(deaths_panel(spark, root, grain), **kw)


def _vax(fn, grain="nation", **kw) -> Builder:
    return lambda spark, root: fn(vax_panel(spark, root, grain), **kw)


def _panels(spark: SparkSession, root: str, grain: str) -> tuple[DataFrame, DataFrame]:
    tables = Tables(spark, root)
    return deaths_panel(spark, root, grain, tables), vax_panel(spark, root, grain, tables)


def _both(fn, grain="nation", **kw) -> Builder:
    return lambda spark, root: fn(*_panels(spark, root, grain), **kw)


def _vax_deaths(fn, grain="nation", **kw) -> Builder:
    return lambda spark, root: fn(*reversed(_panels(spark, root, grain)), **kw)


JOBS: list[Query] = [
    Query("dataset_overview", _both(ex.dataset_overview), J.dataset_overview(), "job"),
    Query("column_completeness", _both(ex.column_completeness), J.column_completeness(), "job"),
    Query("group_distribution", _deaths(ex.group_distribution), J.GROUP_DISTRIBUTION, "job"),
    Query("group_value_stats", _deaths(ex.group_value_stats), J.group_value_stats(), "job"),
    Query("entity_coverage", _deaths(ex.entity_coverage), J.entity_coverage(), "job"),
    Query("entity_coverage_reported", _deaths(ex.entity_coverage, reported="new_cases"),
          J.entity_coverage("new_cases"), "job"),
    Query("rolling_outliers", _deaths(ex.rolling_outliers), J.rolling_outliers(), "job"),
    Query("rolling_outliers_by_days", _deaths(ex.rolling_outliers, by_days=True), J.rolling_outliers(True), "job"),
    Query("consistency_check", _deaths(ex.consistency_check), J.CONSISTENCY_CHECK, "job"),
    Query("latest_summary", _deaths(ex.latest_summary), J.LATEST_SUMMARY, "job"),
    Query("global_trend", _deaths(ga.global_trend, start_date=TREND_START), J.global_trend(TREND_START), "job"),
    Query("entity_rankings", _deaths(ga.entity_rankings), J.ENTITY_RANKINGS, "job"),
    Query("group_percentiles", _deaths(ga.group_percentiles), J.GROUP_PERCENTILES, "job"),
    Query("peak_days", _deaths(ga.peak_days), J.PEAK_DAYS, "job"),
    Query("growth_phases", _deaths(ga.growth_phases), J.GROWTH_PHASES, "job"),
    Query("entity_phase_spans", _deaths(ga.entity_phase_spans), J.ENTITY_PHASE_SPANS, "job"),
    Query("lagged_association", _deaths(ga.lagged_association), J.lagged_association(), "job"),
    Query("lagged_association_lead_corr", _deaths(ga.lagged_association, direction="lead", with_corr=True),
          J.lagged_association("lead", True), "job"),
    Query("latest_coverage", _vax(vx.latest_coverage), J.LATEST_COVERAGE, "job"),
    Query("phase_effectiveness", _vax_deaths(vx.phase_effectiveness), J.phase_effectiveness(), "job"),
    Query("phase_effectiveness_by_days", _vax_deaths(vx.phase_effectiveness, by_days=True),
          J.phase_effectiveness(True), "job"),
    Query("milestone_timeline", _vax(vx.milestone_timeline), J.milestone_timeline(), "job"),
    Query("level_outcomes", _vax_deaths(vx.level_outcomes), J.level_outcomes(), "job"),
    Query("booster_outcomes", _vax_deaths(vx.booster_outcomes), J.BOOSTER_OUTCOMES, "job"),
    Query("inequality", _vax(vx.inequality), J.inequality(), "job"),
    # Options of the jobs.
    Query("rolling_outliers_low", _deaths(ex.rolling_outliers, side="low"), J.rolling_outliers(side="low"), "job"),
    Query("rolling_outliers_both_sample", _deaths(ex.rolling_outliers, side="both", ddof=1),
          J.rolling_outliers(side="both", ddof=1), "job"),
    Query("group_value_stats_sample", _deaths(ex.group_value_stats, ddof=1), J.group_value_stats(1), "job"),
    Query("inequality_sample", _vax(vx.inequality, ddof=1), J.inequality(1), "job"),
    Query("milestone_timeline_first", _vax(vx.milestone_timeline, crossing="first"),
          J.milestone_timeline("first"), "job"),
    Query("lagged_association_by_days", _deaths(ga.lagged_association, by_days=True),
          J.lagged_association(by_days=True), "job"),
    Query("level_outcomes_by_days_corr", _vax_deaths(vx.level_outcomes, by_days=True, with_corr=True),
          J.level_outcomes(True, True), "job"),
]


# The same jobs over supplier-grain panels: one series per supplier, so the
# panels (and every window, join and ranking on them) grow with the data.
_S = "supplier"
JOBS += [
    Query("dataset_overview_by_supplier", _both(ex.dataset_overview, _S), J.dataset_overview(), "job", _S),
    Query("column_completeness_by_supplier", _both(ex.column_completeness, _S), J.column_completeness(), "job", _S),
    Query("group_distribution_by_supplier", _deaths(ex.group_distribution, _S), J.GROUP_DISTRIBUTION, "job", _S),
    Query("group_value_stats_by_supplier", _deaths(ex.group_value_stats, _S), J.group_value_stats(), "job", _S),
    Query("entity_coverage_by_supplier", _deaths(ex.entity_coverage, _S, reported="new_cases"),
          J.entity_coverage("new_cases"), "job", _S),
    Query("consistency_check_by_supplier", _deaths(ex.consistency_check, _S), J.CONSISTENCY_CHECK, "job", _S),
    Query("latest_summary_by_supplier", _deaths(ex.latest_summary, _S), J.LATEST_SUMMARY, "job", _S),
    Query("group_percentiles_by_supplier", _deaths(ga.group_percentiles, _S), J.GROUP_PERCENTILES, "job", _S),
    Query("growth_phases_by_supplier", _deaths(ga.growth_phases, _S), J.GROWTH_PHASES, "job", _S),
    Query("rolling_outliers_by_supplier", _deaths(ex.rolling_outliers, _S), J.rolling_outliers(), "job", _S),
    Query("global_trend_by_supplier", _deaths(ga.global_trend, _S, start_date=TREND_START),
          J.global_trend(TREND_START), "job", _S),
    Query("entity_rankings_by_supplier", _deaths(ga.entity_rankings, _S), J.ENTITY_RANKINGS, "job", _S),
    Query("peak_days_by_supplier", _deaths(ga.peak_days, _S), J.PEAK_DAYS, "job", _S),
    Query("lagged_association_by_supplier", _deaths(ga.lagged_association, _S), J.lagged_association(), "job", _S),
    Query("latest_coverage_by_supplier", _vax(vx.latest_coverage, _S), J.LATEST_COVERAGE, "job", _S),
    Query("phase_effectiveness_by_supplier", _vax_deaths(vx.phase_effectiveness, _S), J.phase_effectiveness(),
          "job", _S),
    Query("milestone_timeline_by_supplier", _vax(vx.milestone_timeline, _S), J.milestone_timeline(), "job", _S),
    Query("level_outcomes_by_supplier", _vax_deaths(vx.level_outcomes, _S), J.level_outcomes(), "job", _S),
    Query("booster_outcomes_by_supplier", _vax_deaths(vx.booster_outcomes, _S), J.BOOSTER_OUTCOMES, "job", _S),
    Query("inequality_by_supplier", _vax(vx.inequality, _S), J.inequality(), "job", _S),
]


def all_queries() -> list[Query]:
    from panelspark.plans import primitives, series

    return JOBS + primitives.QUERIES + series.queries(TREND_START)


def builders() -> dict[str, Builder]:
    return {q.name: q.build for q in all_queries()}


def oracle_sql() -> dict[str, str]:
    return {q.name: q.oracle() for q in all_queries() if q.sql is not None}
