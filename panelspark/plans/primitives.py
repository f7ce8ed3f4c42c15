"""Registered queries for the reusable operators and the relational primitives.

The twenty jobs compose these; registering them on their own checks each one
against the oracle over the whole derived panels (not just through a job's
final top-k), including the variants the jobs do not use (day-based frames,
LEAD, sample standard deviation, distributed global row numbers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions import bands
from panelspark.functions.ratios import growth_pct, pct_ratio
from panelspark.operators.joins import duplicate_keys, panel_join
from panelspark.operators.latest import latest_global, latest_per_entity, rows_at_entity_latest
from panelspark.operators.milestones import crossings, pivot_dates
from panelspark.operators.profile import two_level_profile
from panelspark.operators.ranking import global_row_number
from panelspark.operators.rolling import rolling, shifted
from panelspark.oracle.jobs_sql import CROSSED, OWN, OWN_VAX, PHASE_BANDS, exact_pct
from panelspark.plans.exploration import grouped_rows
from panelspark.plans.vaccination import COVERAGE, MILESTONE_COLUMNS
from panelspark.sources.panels import deaths_panel, vax_panel
from panelspark.sources.tables import read_table


def _q(name, build, sql, kind="operator"):
    from panelspark.catalog import Query

    return Query(name, build, sql, kind)


# --- operators ---------------------------------------------------------------

def _latest_global(spark: SparkSession, root: str) -> DataFrame:
    d = deaths_panel(spark, root).select(
        "continent", "location", "date", "population", "total_cases", "total_deaths"
    )
    return latest_global(d, "date", F.col("continent").isNotNull())


LATEST_GLOBAL_SQL = f"""
WITH {OWN}
SELECT continent, location, date, population, total_cases, total_deaths
FROM own WHERE NOT EXISTS (SELECT 1 FROM (SELECT MAX(date) AS newest FROM own) WHERE newest > own.date)
"""


def _latest_per_entity(spark: SparkSession, root: str) -> DataFrame:
    v = grouped_rows(vax_panel(spark, root))
    return latest_per_entity(v, reported=F.col("total_vaccinations").isNotNull()).select(
        "location", "date", "total_vaccinations", "people_fully_vaccinated"
    )


LATEST_PER_ENTITY_SQL = f"""
WITH {OWN_VAX}
SELECT location, MAX(date) AS date, arg_max(total_vaccinations, date) AS total_vaccinations,
       arg_max(people_fully_vaccinated, date) AS people_fully_vaccinated
FROM own_vax WHERE total_vaccinations IS NOT NULL GROUP BY location
"""


def _rows_at_entity_latest(spark: SparkSession, root: str) -> DataFrame:
    v = vax_panel(spark, root)
    return rows_at_entity_latest(v, reported=F.col(COVERAGE).isNotNull()).select("location", "date", COVERAGE)


ROWS_AT_ENTITY_LATEST_SQL = f"""
WITH reported AS (SELECT location, date, {COVERAGE} FROM vax_panel WHERE {COVERAGE} IS NOT NULL),
last_days AS (SELECT location, MAX(date) AS date FROM reported GROUP BY location)
SELECT r.* FROM reported r JOIN last_days l ON l.location = r.location AND l.date = r.date
"""


def _rolling_stats(spark: SparkSession, root: str) -> DataFrame:
    d = grouped_rows(deaths_panel(spark, root)).where(F.col("new_cases").isNotNull())
    return d.select(
        "location",
        "date",
        "new_cases",
        F.round(rolling("new_cases", -6, 0, "avg"), 3).alias("avg_7_rows"),
        F.round(rolling("new_cases", -13, 0, "avg"), 3).alias("avg_14_rows"),
        F.round(rolling("new_cases", -7, -1, "stddev_pop"), 3).alias("std_pop_prev_7_rows"),
        F.round(rolling("new_cases", -7, -1, "stddev_samp"), 3).alias("std_samp_prev_7_rows"),
        rolling("new_cases", -6, 0, "sum", by_days=True).alias("sum_7_days"),
        rolling("new_cases", -6, 0, "count", by_days=True).alias("reports_7_days"),
    )


ROLLING_STATS_SQL = f"""
SELECT location, date, new_cases,
       ROUND(AVG(new_cases) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 3)
           AS avg_7_rows,
       ROUND(AVG(new_cases) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), 3)
           AS avg_14_rows,
       ROUND(STDDEV_POP(new_cases) OVER prev7, 3) AS std_pop_prev_7_rows,
       ROUND(STDDEV_SAMP(new_cases) OVER prev7, 3) AS std_samp_prev_7_rows,
       CAST(SUM(new_cases) OVER days7 AS BIGINT) AS sum_7_days,
       COUNT(new_cases) OVER days7 AS reports_7_days
FROM deaths_panel
WHERE continent IS NOT NULL AND new_cases IS NOT NULL
WINDOW prev7 AS (PARTITION BY location ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
       days7 AS (PARTITION BY location ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
"""


def _shifts_and_growth(spark: SparkSession, root: str) -> DataFrame:
    d = grouped_rows(deaths_panel(spark, root)).where(F.col("total_cases").isNotNull())
    return d.select(
        "location",
        "date",
        "total_cases",
        shifted("new_deaths", 14).alias("new_deaths_lag_14"),
        shifted("new_deaths", -14).alias("new_deaths_lead_14"),
        growth_pct("total_cases", shifted("total_cases", 1), 2).alias("growth_percent"),
    )


SHIFTS_AND_GROWTH_SQL = f"""
SELECT location, date, total_cases,
       LAG(new_deaths, 14) OVER s AS new_deaths_lag_14,
       LEAD(new_deaths, 14) OVER s AS new_deaths_lead_14,
       CASE WHEN LAG(total_cases, 1) OVER s > 0
            THEN {exact_pct('(total_cases - LAG(total_cases, 1) OVER s)', '(LAG(total_cases, 1) OVER s)')}
       END AS growth_percent
FROM deaths_panel
WHERE continent IS NOT NULL AND total_cases IS NOT NULL
WINDOW s AS (PARTITION BY location ORDER BY date)
"""


def _ratios_and_bands(spark: SparkSession, root: str) -> DataFrame:
    v = grouped_rows(vax_panel(spark, root))
    phase = bands.VACCINATION_PHASES.label(COVERAGE)
    level = bands.VACCINATION_LEVELS.label(COVERAGE)
    booster = bands.BOOSTER_LEVELS.label("total_boosters_per_hundred")
    development = bands.DEVELOPMENT_LEVELS.label("human_development_index")
    return v.select(
        "location",
        "date",
        pct_ratio("people_fully_vaccinated", "population", 2).alias("fully_vaccinated_rate"),
        pct_ratio("total_boosters", "people_fully_vaccinated", 2).alias("booster_uptake_rate"),
        phase.alias("vaccination_phase"),
        bands.VACCINATION_PHASES.ordinal(phase).alias("phase_order"),
        level.alias("vaccination_level"),
        bands.VACCINATION_LEVELS.ordinal(level).alias("level_order"),
        booster.alias("booster_level"),
        development.alias("development_level"),
    )


# A NULL coverage gets the last arm of its banding.
RATIOS_AND_BANDS_SQL = f"""
SELECT location, date,
       {exact_pct('people_fully_vaccinated', 'population')} AS fully_vaccinated_rate,
       {exact_pct('total_boosters', 'people_fully_vaccinated')} AS booster_uptake_rate,
       CASE WHEN {COVERAGE} < 10 THEN 'Pre-Vaccination (<10%)' WHEN {COVERAGE} < 30 THEN 'Early Vaccination (10-30%)'
            WHEN {COVERAGE} < 50 THEN 'Mid Vaccination (30-50%)' WHEN {COVERAGE} < 70 THEN 'High Vaccination (50-70%)'
            ELSE 'Full Vaccination (>70%)' END AS vaccination_phase,
       CASE WHEN {COVERAGE} < 10 THEN 1 WHEN {COVERAGE} < 30 THEN 2 WHEN {COVERAGE} < 50 THEN 3
            WHEN {COVERAGE} < 70 THEN 4 ELSE 5 END AS phase_order,
       CASE WHEN {COVERAGE} > 50 THEN 'High Vaccination (>50%)' WHEN {COVERAGE} > 30 THEN 'Medium Vaccination (30-50%)'
            WHEN {COVERAGE} > 10 THEN 'Low Vaccination (10-30%)' ELSE 'Minimal Vaccination (<10%)' END
           AS vaccination_level,
       CASE WHEN {COVERAGE} > 50 THEN 4 WHEN {COVERAGE} > 30 THEN 3 WHEN {COVERAGE} > 10 THEN 2 ELSE 1 END AS level_order,
       CASE WHEN total_boosters_per_hundred > 30 THEN 'High Booster Coverage (>30%)'
            WHEN total_boosters_per_hundred > 15 THEN 'Medium Booster Coverage (15-30%)'
            WHEN total_boosters_per_hundred > 5 THEN 'Low Booster Coverage (5-15%)'
            ELSE 'Minimal Booster Coverage (<5%)' END AS booster_level,
       CASE WHEN human_development_index >= 0.8 THEN 'Very High Development'
            WHEN human_development_index >= 0.7 THEN 'High Development'
            WHEN human_development_index >= 0.55 THEN 'Medium Development' ELSE 'Low Development' END
           AS development_level
FROM vax_panel WHERE continent IS NOT NULL
"""


def _crossings(spark: SparkSession, root: str) -> DataFrame:
    v = grouped_rows(vax_panel(spark, root)).where(F.col(COVERAGE).isNotNull())
    marked = crossings(v, COVERAGE, bands.MILESTONES).where(F.col("milestone_reached").isNotNull())
    again = Window.partitionBy("location", "milestone_reached").orderBy("date")
    return marked.select(
        "location", "date", COVERAGE, "milestone_reached",
        F.row_number().over(again).cast("long").alias("crossing_number"),
    )


CROSSINGS_SQL = f"""
WITH {CROSSED}
SELECT x.location, x.date, x.cov AS {COVERAGE}, x.milestone_reached,
       (SELECT COUNT(*) FROM crossed o
        WHERE o.location = x.location AND o.threshold = x.threshold AND o.date <= x.date) AS crossing_number
FROM crossed x
"""


def _pivot_dates(spark: SparkSession, root: str) -> DataFrame:
    v = grouped_rows(vax_panel(spark, root)).where(F.col(COVERAGE).isNotNull())
    marked = crossings(v, COVERAGE, bands.MILESTONES).where(F.col("milestone_reached").isNotNull())
    return pivot_dates(marked, ("location", "continent"), "milestone_reached", "date", MILESTONE_COLUMNS)


PIVOT_DATES_SQL = f"""
WITH {CROSSED}
SELECT location, continent, MAX(date) FILTER (threshold = 10) AS reached_10_percent,
       MAX(date) FILTER (threshold = 30) AS reached_30_percent, MAX(date) FILTER (threshold = 50) AS reached_50_percent,
       MAX(date) FILTER (threshold = 70) AS reached_70_percent
FROM crossed GROUP BY location, continent
"""


def _joined(spark: SparkSession, root: str) -> DataFrame:
    v = grouped_rows(vax_panel(spark, root)).where(F.col(COVERAGE).isNotNull()).select("location", "date", COVERAGE)
    d = grouped_rows(deaths_panel(spark, root)).where(F.col("new_cases").isNotNull()).select(
        "location", "date", "new_cases", "new_deaths"
    )
    return panel_join(v, d)


def _panel_join(spark: SparkSession, root: str) -> DataFrame:
    return _joined(spark, root).select(
        "location", "date", COVERAGE, "new_cases", rolling("new_cases", -6, 0, "avg").alias("cases_7day_avg")
    )


_JOINED_SQL = f"""
joined AS (
    SELECT v.location, v.date, v.{COVERAGE}, d.new_cases, d.new_deaths
    FROM vax_panel v JOIN deaths_panel d ON v.location = d.location AND v.date = d.date
    WHERE v.continent IS NOT NULL AND d.continent IS NOT NULL AND v.{COVERAGE} IS NOT NULL
      AND d.new_cases IS NOT NULL
)"""

PANEL_JOIN_SQL = f"""WITH {_JOINED_SQL}
SELECT location, date, {COVERAGE}, new_cases,
       AVG(new_cases) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
           AS cases_7day_avg
FROM joined
"""


def _phase_cells(spark: SparkSession, root: str) -> DataFrame:
    rows = _joined(spark, root).withColumn("vaccination_phase", bands.VACCINATION_PHASES.label(COVERAGE))
    return two_level_profile(
        rows,
        "vaccination_phase",
        stage1=[F.sum("new_cases").alias("cases"), F.round(F.avg(COVERAGE), 2).alias("mean_coverage")],
        stage2=[
            F.count_distinct("location").alias("entities"),
            F.sum("_rows").alias("rows_in_cells"),
            F.sum("cases").alias("cases"),
            F.round(F.max("mean_coverage"), 2).alias("max_entity_coverage"),
        ],
        min_rows=7,
    )


PHASE_CELLS_SQL = f"""WITH {_JOINED_SQL}, {PHASE_BANDS},
cells AS (
    SELECT location, vaccination_phase, COUNT(*) AS n,
           CAST(SUM(new_cases) AS BIGINT) AS cases, ROUND(AVG({COVERAGE}), 2) AS mean_coverage
    FROM joined JOIN phases ON {COVERAGE} >= lo AND {COVERAGE} < hi GROUP BY 1, 2 HAVING COUNT(*) > 7
)
SELECT vaccination_phase, COUNT(DISTINCT location) AS entities, CAST(SUM(n) AS BIGINT) AS rows_in_cells,
       CAST(SUM(cases) AS BIGINT) AS cases, ROUND(MAX(mean_coverage), 2) AS max_entity_coverage
FROM cells GROUP BY vaccination_phase
"""


def _duplicate_keys(spark: SparkSession, root: str) -> DataFrame:
    """Customers with several orders on a day: keys that do repeat, checked beside the panels', which do not."""
    orders = read_table(spark, root, "orders").select(
        F.col("o_custkey").cast("string").alias("location"), F.to_date("o_orderdate").alias("date")
    )
    panels = duplicate_keys(deaths_panel(spark, root)).unionByName(duplicate_keys(vax_panel(spark, root)))
    return duplicate_keys(orders).unionByName(panels)


DUPLICATE_KEYS_SQL = """
WITH every AS (
    SELECT 'o' AS t, CAST(o_custkey AS VARCHAR) AS location, CAST(o_orderdate AS DATE) AS date FROM orders
    UNION ALL SELECT 'd', location, date FROM deaths_panel
    UNION ALL SELECT 'v', location, date FROM vax_panel
)
SELECT location, date, COUNT(*) AS copies FROM every GROUP BY t, location, date HAVING COUNT(*) > 1
"""


def _global_row_number(spark: SparkSession, root: str) -> DataFrame:
    d = grouped_rows(deaths_panel(spark, root)).where(F.col("new_cases").isNotNull()).select(
        "location", "date", "new_cases"
    )
    return global_row_number(d, [F.col("new_cases").desc(), F.col("location"), F.col("date")], "position")


GLOBAL_ROW_NUMBER_SQL = f"""
SELECT location, date, new_cases,
       ROW_NUMBER() OVER (ORDER BY new_cases DESC, location, date) AS position
FROM deaths_panel WHERE continent IS NOT NULL AND new_cases IS NOT NULL
"""


# --- primitives on the panels -----------------------------------------------

def _scan_deaths(spark: SparkSession, root: str) -> DataFrame:
    return deaths_panel(spark, root)


def _scan_vax(spark: SparkSession, root: str) -> DataFrame:
    return vax_panel(spark, root)


def _grouped_aggregates(spark: SparkSession, root: str) -> DataFrame:
    d = grouped_rows(deaths_panel(spark, root)).where(F.col("date") >= F.lit("1996-01-01").cast("date"))
    return (
        d.groupBy("continent", F.year("date").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("new_cases").alias("reported_days"),
            F.count_distinct("location").alias("entities"),
            F.count_distinct("population").alias("population_values"),
            F.sum("new_cases").alias("cases"),
            F.round(F.avg("new_cases"), 2).alias("mean_cases"),
            F.min("new_deaths").alias("min_deaths"),
            F.max("new_deaths").alias("max_deaths"),
            F.round(F.stddev_pop("new_cases"), 2).alias("std_pop_cases"),
            F.round(F.stddev_samp("new_cases"), 2).alias("std_samp_cases"),
            F.max(F.when(F.col("new_deaths") > 0, F.col("date"))).alias("last_death_day"),
        )
        .where(F.col("reported_days") > 100)
    )


GROUPED_AGGREGATES_SQL = f"""
SELECT continent, CAST(year(date) AS INTEGER) AS year, COUNT(*) AS row_count, COUNT(new_cases) AS reported_days,
       COUNT(DISTINCT location) AS entities, COUNT(DISTINCT population) AS population_values,
       CAST(SUM(new_cases) AS BIGINT) AS cases, ROUND(AVG(new_cases), 2) AS mean_cases,
       MIN(new_deaths) AS min_deaths, MAX(new_deaths) AS max_deaths,
       ROUND(STDDEV_POP(new_cases), 2) AS std_pop_cases, ROUND(STDDEV_SAMP(new_cases), 2) AS std_samp_cases,
       MAX(CASE WHEN new_deaths > 0 THEN date END) AS last_death_day
FROM deaths_panel WHERE continent IS NOT NULL AND date >= DATE '1996-01-01'
GROUP BY continent, year(date)
HAVING COUNT(new_cases) > 100
"""


def _entity_ranks(spark: SparkSession, root: str) -> DataFrame:
    d = grouped_rows(deaths_panel(spark, root)).where(F.col("new_deaths").isNotNull())
    by_deaths = Window.partitionBy("location").orderBy(F.col("new_deaths").desc())
    return d.select(
        "location",
        "date",
        "new_deaths",
        F.rank().over(by_deaths).cast("long").alias("death_rank"),
        F.dense_rank().over(by_deaths).cast("long").alias("death_dense_rank"),
        F.round(F.percent_rank().over(Window.partitionBy("location").orderBy("new_deaths")), 6).alias("death_pct_rank"),
        F.row_number().over(Window.partitionBy("location").orderBy(F.col("date").desc())).cast("long")
        .alias("recency"),
        F.max("new_deaths").over(Window.partitionBy("location")).alias("entity_max_deaths"),
        F.min("date").over(Window.partitionBy("location")).alias("first_report"),
    )


ENTITY_RANKS_SQL = f"""
SELECT location, date, new_deaths,
       RANK() OVER (PARTITION BY location ORDER BY new_deaths DESC) AS death_rank,
       DENSE_RANK() OVER (PARTITION BY location ORDER BY new_deaths DESC) AS death_dense_rank,
       ROUND(PERCENT_RANK() OVER (PARTITION BY location ORDER BY new_deaths NULLS FIRST), 6) AS death_pct_rank,
       ROW_NUMBER() OVER (PARTITION BY location ORDER BY date DESC) AS recency,
       MAX(new_deaths) OVER (PARTITION BY location) AS entity_max_deaths,
       MIN(date) OVER (PARTITION BY location) AS first_report
FROM deaths_panel WHERE continent IS NOT NULL AND new_deaths IS NOT NULL
"""


def _date_filter_union(spark: SparkSession, root: str) -> DataFrame:
    d = grouped_rows(deaths_panel(spark, root))
    v = grouped_rows(vax_panel(spark, root))
    cutoff = F.lit("2001-01-01").cast("date")
    recent_cases = d.where((F.col("date") >= cutoff) & (F.col("new_cases") > 0)).select(
        F.lit("cases").alias("measure"), "location", "date", F.col("new_cases").alias("amount")
    )
    recent_vax = v.where((F.col("date") >= cutoff) & (F.col("new_vaccinations") > 0)).select(
        F.lit("vaccinations").alias("measure"), "location", "date", F.col("new_vaccinations").alias("amount")
    )
    return recent_cases.unionByName(recent_vax).select(
        "measure", "location", "date", "amount",
        F.date_diff(F.col("date"), cutoff).cast("long").alias("days_after_cutoff"),
    )


DATE_FILTER_UNION_SQL = f"""
SELECT measure, location, date, amount, CAST(date_diff('day', DATE '2001-01-01', date) AS BIGINT) AS days_after_cutoff
FROM (
    SELECT 'cases' AS measure, location, date, new_cases AS amount
    FROM deaths_panel WHERE continent IS NOT NULL AND date >= DATE '2001-01-01' AND new_cases > 0
    UNION ALL
    SELECT 'vaccinations', location, date, new_vaccinations
    FROM vax_panel WHERE continent IS NOT NULL AND date >= DATE '2001-01-01' AND new_vaccinations > 0
) t
"""


QUERIES = [
    _q("latest_global", _latest_global, LATEST_GLOBAL_SQL),
    _q("latest_per_entity", _latest_per_entity, LATEST_PER_ENTITY_SQL),
    _q("rows_at_entity_latest", _rows_at_entity_latest, ROWS_AT_ENTITY_LATEST_SQL),
    _q("rolling_stats", _rolling_stats, ROLLING_STATS_SQL),
    _q("shifts_and_growth", _shifts_and_growth, SHIFTS_AND_GROWTH_SQL),
    _q("ratios_and_bands", _ratios_and_bands, RATIOS_AND_BANDS_SQL),
    _q("crossings", _crossings, CROSSINGS_SQL),
    _q("pivot_dates", _pivot_dates, PIVOT_DATES_SQL),
    _q("panel_join", _panel_join, PANEL_JOIN_SQL),
    _q("phase_cells", _phase_cells, PHASE_CELLS_SQL),
    _q("duplicate_keys", _duplicate_keys, DUPLICATE_KEYS_SQL),
    _q("global_row_number", _global_row_number, GLOBAL_ROW_NUMBER_SQL),
    _q("scan_deaths", _scan_deaths, "SELECT * FROM deaths_panel", "primitive"),
    _q("scan_vax", _scan_vax, "SELECT * FROM vax_panel", "primitive"),
    _q("grouped_aggregates", _grouped_aggregates, GROUPED_AGGREGATES_SQL, "primitive"),
    _q("entity_ranks", _entity_ranks, ENTITY_RANKS_SQL, "primitive"),
    _q("date_filter_union", _date_filter_union, DATE_FILTER_UNION_SQL, "primitive"),
]
