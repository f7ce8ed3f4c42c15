"""Queries on stored panels, and on series as such: runs, peaks, seasons, lags and as-of matches.

Each comes with DuckDB SQL that gets the same rows another way.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators import (
    asof_join,
    best_lag,
    checked_panel_join,
    distinct_ids,
    follow,
    id_bitmaps,
    lag_correlations,
    runs,
    seasonal_indices,
    trailing_days,
)
from panelspark.oracle import series_sql as S
from panelspark.oracle.jobs_sql import LATEST_SUMMARY, global_trend as global_trend_sql
from panelspark.plans.exploration import grouped_rows, latest_summary
from panelspark.plans.global_analysis import global_trend
from panelspark.session import ensure_checkpoint_dir
from panelspark.sources.csv import DEATHS_SCHEMA, read_panel_csv_checked
from panelspark.sources.panels import calendar, deaths_panel, entities, fact_days, vax_panel
from panelspark.sources.stored import StoredPanel
from panelspark.sources.tables import Tables
from panelspark.spec import DEFAULT, PanelSpec

#: Days of facts that come in by a refresh after the build.
REFRESHED_DAYS = 45


def _own_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- stored panels ------------------------------------------------------------

def refreshed_store(spark: SparkSession, root: str, kind: str = "outcomes", grain: str = "nation") -> StoredPanel:
    """A panel that was built up to ``REFRESHED_DAYS`` before the last facts, then refreshed with the rest."""
    store = StoredPanel(spark, _own_folder(spark, f"stored-{kind}"), root, kind, grain, span="month")
    last = fact_days(Tables(spark, root)).first()["ends"]["last"]
    if last is None:
        store.build()
        return store
    cut = last - dt.timedelta(days=REFRESHED_DAYS)
    store.build(until=cut)
    store.refresh(cut + dt.timedelta(days=1))
    return store


def _stored_outcomes(spark: SparkSession, root: str) -> DataFrame:
    return refreshed_store(spark, root).panel()


def _stored_coverage(spark: SparkSession, root: str) -> DataFrame:
    return refreshed_store(spark, root, "coverage").panel()


def _stored_latest(spark: SparkSession, root: str) -> DataFrame:
    """The rows at the latest date, from one partition."""
    store = refreshed_store(spark, root, grain="supplier")
    return grouped_rows(store.panel(store.latest())).select(
        "continent", "location", "date", "population", "total_cases", "total_deaths"
    )


def _stored_latest_summary(spark: SparkSession, root: str) -> DataFrame:
    store = refreshed_store(spark, root)
    return latest_summary(store.panel(store.latest()))


def _stored_global_trend(spark: SparkSession, root: str, start_date: str) -> DataFrame:
    return global_trend(refreshed_store(spark, root).panel(), start_date=start_date)


# --- distinct counts ----------------------------------------------------------

def _reporting():
    return {
        "reporting_cases": F.col("new_cases").isNotNull(),
        "reporting_deaths": F.col("new_deaths") > 0,
        "large_days": F.col("new_cases") >= 500,
    }


def _reports(tables: Tables, key: str, value: Column) -> DataFrame:
    """(key, continent, supplier's key k, a flag per condition): the reports of the supplier panel.

    The panel's rows without a report are not joined to the suppliers: a row stands for those of
    each group, with k 0 and no flag.
    """
    spark, root = tables.spark, tables.root
    flags = {name: F.coalesce(met, F.lit(False)) for name, met in _reporting().items()}
    marked = (
        grouped_rows(deaths_panel(spark, root, "supplier", tables)).where(F.col("location").isNotNull())
        .select("continent", value.alias(key), "location", *[met.alias(name) for name, met in flags.items()])
    )
    owner = F.when(F.greatest(*flags), F.col("location"))
    reports = marked.groupBy("continent", key, owner.alias("location")).agg(*[F.max(n).alias(n) for n in flags])
    ids = entities(spark, root, "supplier", tables).select("k", "location").where(F.col("k").isNotNull())
    return reports.join(ids, "location", "left").withColumn("k", F.coalesce("k", F.lit(0).cast("long")))


def _rolling_distinct(spark: SparkSession, root: str) -> DataFrame:
    """Distinct reporting entities over each day's trailing 7 days."""
    tables = Tables(spark, root)
    names = list(_reporting())
    reports = _reports(tables, "date", F.col("date"))
    daily = id_bitmaps(reports, ["date"], "k", {n: F.col(n) for n in names})
    counts = distinct_ids(trailing_days(daily, 7), ["date"], names)
    return counts.where(F.col("date") <= calendar(tables)[1])


def _monthly_distinct(spark: SparkSession, root: str) -> DataFrame:
    """Distinct reporting entities per group and month, and per group over all months (month NULL)."""
    names = list(_reporting())
    reports = _reports(Tables(spark, root), "month", F.trunc("date", "month"))
    monthly = id_bitmaps(reports, ["continent", "month"], "k", {n: F.col(n) for n in names})
    whole = distinct_ids(monthly, ["continent"], names).withColumn("month", F.lit(None).cast("date"))
    return distinct_ids(monthly, ["continent", "month"], names).unionByName(whole)


# --- joins --------------------------------------------------------------------

def _panel_join_checked(spark: SparkSession, root: str) -> DataFrame:
    """Orders (several a day and nation) against the coverage panel, with the copies of each key."""
    tables = Tables(spark, root)
    orders = (
        tables["orders"].select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("date"))
        .join(tables["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(entities(spark, root, "nation", tables), F.col("c_nationkey") == F.col("k"))
        .select("location", "date", F.floor(F.col("o_totalprice") / 100).alias("amount"))
    )
    coverage = grouped_rows(vax_panel(spark, root, tables=tables)).select("location", "date", "new_vaccinations")
    joined, _ = checked_panel_join(orders, coverage)
    return joined.groupBy("location", "date").agg(
        F.count(F.lit(1)).alias("joined_rows"), F.max("left_copies").alias("left_copies"),
        F.max("right_copies").alias("right_copies"), F.sum("amount").alias("amount"),
        F.max("new_vaccinations").alias("new_vaccinations"),
    )


def _asof(spark: SparkSession, root: str, grain: str, **options) -> DataFrame:
    """Each case report with the coverage last reported on or before its day."""
    tables = Tables(spark, root)
    d = grouped_rows(deaths_panel(spark, root, grain, tables)).where(F.col("new_cases").isNotNull())
    v = grouped_rows(vax_panel(spark, root, "nation", tables)).where(F.col("new_vaccinations").isNotNull())
    if grain == "supplier":  # the nation's coverage
        d, v = d.withColumnRenamed("continent", "nation"), v.withColumnRenamed("location", "nation")
        return asof_join(
            d.select("nation", "location", "date", "new_cases"), v.select("nation", "date", "total_vaccinations"),
            ["total_vaccinations"], by=("nation",), **options,
        )
    return asof_join(
        d.select("location", "date", "new_cases"), v.select("location", "date", "total_vaccinations"),
        ["total_vaccinations"], **options,
    )


# --- series -------------------------------------------------------------------

def spaced_peaks(deaths: DataFrame, gap_days: int = 14, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Peak days of each entity, taken greedily in date order: the first peak, then always the first
    one at least ``gap_days`` after the last taken.

    A peak is a report above the one before and not below the one after it. Whether one is
    taken depends on all before it, so no window can tell. Each peak points to the one that
    would follow it, a window over days, and the taken ones are those that the first leads to.
    """
    series = Window.partitionBy(spec.entity).orderBy(spec.date)
    value = F.col("new_cases")
    before, after = F.lag(value).over(series), F.lead(value).over(series)
    peaks = (
        grouped_rows(deaths, spec).where(value.isNotNull())
        .select(
            spec.entity, spec.date, value,
            (F.coalesce(value > before, F.lit(True)) & F.coalesce(value >= after, F.lit(True))).alias("_peak"),
        )
        .where("_peak")
    )
    day = Window.partitionBy(spec.entity).orderBy(F.unix_date(F.col(spec.date)))
    pointers = peaks.select(
        spec.entity, spec.date, "new_cases",
        F.min(spec.date).over(day.rangeBetween(gap_days, Window.unboundedFollowing)).alias("_next"),
        (F.row_number().over(series) == 1).alias("_first"),
    )
    taken = follow(pointers, [spec.entity], spec.date, "_next", "_first")
    return taken.join(peaks, [spec.entity, spec.date]).select(
        spec.entity, spec.date, "new_cases", F.row_number().over(series).cast("long").alias("peak_number")
    )


def seasonal_patterns(deaths: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Weekday indices against a centred week, and month indices against a centred year."""
    d = F.col(spec.date)
    found = seasonal_indices(
        grouped_rows(deaths, spec), "new_cases", {"weekday": (F.weekday(d) + 1, 3), "month": (F.month(d), 182)},
        spec.entity, spec.date,
    )
    return found.withColumn("seasonal_index", F.round("seasonal_index", 6))


def coverage_runs(deaths: DataFrame, reported: str = "new_cases", spec: PanelSpec = DEFAULT) -> DataFrame:
    """Unbroken runs of reported days, with the reports' sum and the gap before each."""
    rows = grouped_rows(deaths, spec).where(F.col(reported).isNotNull())
    return runs(rows, [F.sum(reported).alias("reported_sum")], spec.entity, spec.date)


def lag_profile(deaths: DataFrame, max_lag: int = 28, min_pairs: int = 30, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The lag, in reports, at which new deaths follow new cases best."""
    rows = grouped_rows(deaths, spec).where(F.col("new_cases").isNotNull())
    return best_lag(lag_correlations(rows, "new_cases", "new_deaths", max_lag, spec.entity, spec.date), min_pairs,
                    entity=spec.entity)


# --- files --------------------------------------------------------------------

_CSV_COLUMNS = ("continent", "location", "date", "population", "total_cases", "new_cases", "total_deaths", "new_deaths")


def _csv_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The outcomes panel written as CSV with damaged rows, and read back with what is wrong with each."""
    day = F.unix_date("date")
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _CSV_COLUMNS}
    text["date"] = F.when(day % 50 == 1, F.lit("n/a")).when(day % 50 == 2, F.lit("")).otherwise(text["date"])
    text["new_cases"] = (
        F.when(day % 50 == 3, F.lit("12.5")).when(day % 50 == 4, F.lit("many")).when(day % 50 == 5, F.lit("7.0"))
        .otherwise(text["new_cases"])
    )
    line = F.concat_ws(",", *text.values())
    damaged = F.when(day % 50 == 6, F.concat(line, F.lit(",extra"))).when(day % 50 == 7, F.lit("cut,short")).otherwise(line)
    path = _own_folder(spark, "panel-csv")
    grouped_rows(deaths_panel(spark, root)).select(damaged.alias("value")).write.text(path)
    schema = T.StructType([DEATHS_SCHEMA[c] for c in _CSV_COLUMNS])
    return read_panel_csv_checked(spark, path, schema, header=_CSV_COLUMNS)


def queries(start_date: str) -> list:
    from panelspark.catalog import Query
    from panelspark.plans.primitives import LATEST_GLOBAL_SQL

    def on_deaths(job):
        return lambda spark, root: job(deaths_panel(spark, root))

    def by_supplier(job):
        return lambda spark, root: job(deaths_panel(spark, root, "supplier"))

    return [
        Query("stored_outcomes", _stored_outcomes, "SELECT * FROM deaths_panel", "source"),
        Query("stored_coverage", _stored_coverage, "SELECT * FROM vax_panel", "source"),
        Query("stored_latest_by_supplier", _stored_latest, LATEST_GLOBAL_SQL, "source", "supplier"),
        Query("stored_latest_summary", _stored_latest_summary, LATEST_SUMMARY, "source"),
        Query("stored_global_trend", lambda spark, root: _stored_global_trend(spark, root, start_date),
              global_trend_sql(start_date), "source"),
        Query("csv_quarantine", _csv_quarantine, S.CSV_QUARANTINE, "source"),
        Query("rolling_distinct_reporters", _rolling_distinct, S.ROLLING_DISTINCT, "operator", "supplier"),
        Query("monthly_distinct_reporters", _monthly_distinct, S.MONTHLY_DISTINCT, "operator", "supplier"),
        Query("panel_join_checked", _panel_join_checked, S.PANEL_JOIN_CHECKED, "operator"),
        Query("asof_reports", lambda spark, root: _asof(spark, root, "nation"), S.ASOF_REPORTS, "operator"),
        Query("asof_nation_coverage_by_supplier",
              lambda spark, root: _asof(spark, root, "supplier", tolerance_days=3, span_days=90),
              S.asof_nation_coverage(3), "operator", "supplier"),
        Query("spaced_peaks", on_deaths(spaced_peaks), S.SPACED_PEAKS, "operator"),
        Query("spaced_peaks_by_supplier", by_supplier(spaced_peaks), S.SPACED_PEAKS, "operator", "supplier"),
        Query("seasonal_patterns", on_deaths(seasonal_patterns), S.SEASONAL_PATTERNS, "operator"),
        Query("coverage_runs", on_deaths(coverage_runs), S.COVERAGE_RUNS, "operator"),
        Query("coverage_runs_by_supplier", by_supplier(coverage_runs), S.COVERAGE_RUNS, "operator", "supplier"),
        Query("lag_profile", on_deaths(lag_profile), S.LAG_PROFILE, "operator"),
    ]
