"""Derive the two entity-day panels from the TPC-H style base tables.

The analysis jobs read two daily panels keyed by (location, date). Two grains
are offered:

``grain="nation"`` (default; entity = nation, group = region)
    * the *outcomes* panel (cases and deaths) from ``orders`` joined to
      ``customer``, per customer nation;
    * the *coverage* panel (vaccinations) from ``lineitem`` joined to
      ``supplier``, per supplier nation.
    25 entities whatever the scale factor.

``grain="supplier"`` (entity = supplier, group = its nation)
    * outcomes from ``lineitem`` per supplier: extended price for cases,
      lines with status 'F' for deaths;
    * coverage from ``lineitem`` per supplier, as above.
    The number of entities grows with the scale factor (1,000 at sf0.1).

Each panel is dense: every entity has one row per calendar day from the first
to the last date of orders and shipments, and days without activity hold NULL measurements.
The outcomes panel also carries one aggregate row per region and day with a
NULL group, the way public country-level panels carry continent totals.

Scale notes
-----------
* The big inputs (orders, lineitem) are reduced by a grouped aggregate on
  (nation, day) right after the dimension join. Spark runs it as partial (map-side)
  plus final aggregation, so the shuffle carries at most one row per
  (nation, day, map task) whatever the skew of the input.
* The join to customer/supplier is an equi-join whose strategy Spark picks
  from measured sizes (broadcast under ``autoBroadcastJoinThreshold``,
  sort-merge above it, with AQE splitting skewed partitions of a hot key).
* Only days with facts, and one first day per entity, go through the two
  shuffles, of the aggregate on (k, date) and of the windows on k. The other
  days are generated after them, from each row to the entity's next one.
* Each table is opened once, and the calendar is one scalar subquery that all its
  uses share.
* The running totals are windows partitioned by entity; the panel key is
  unique, so one window partition holds at most one row per calendar day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.sources.tables import Tables

DEATHS_COLUMNS = (
    "continent", "location", "date", "population", "total_cases", "new_cases",
    "total_deaths", "new_deaths", "new_deaths_per_million", "total_deaths_per_million",
)

VAX_COLUMNS = (
    "continent", "location", "date", "population", "total_vaccinations",
    "people_vaccinated", "people_fully_vaccinated", "total_boosters", "new_vaccinations",
    "people_fully_vaccinated_per_hundred", "total_boosters_per_hundred",
    "gdp_per_capita", "human_development_index",
)


GRAINS = ("nation", "supplier")

#: Daily measures of the two panels, as ``outcome_facts`` and ``coverage_facts`` name them.
OUTCOME_MEASURES = ("new_cases", "new_deaths")
COVERAGE_MEASURES = ("q", "f", "b")


def entities(spark: SparkSession, root: str, grain: str = "nation", tables: Tables | None = None) -> DataFrame:
    """One row per entity: key ``k``, ``location`` (entity name), ``continent`` (group name)."""
    tables = tables or Tables(spark, root)
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")
    if grain == "nation":
        nation = tables["nation"].select("n_nationkey", "n_name", "n_regionkey")
        region = tables["region"].select("r_regionkey", "r_name")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("k"),
            F.col("n_name").alias("location"),
            F.col("r_name").alias("continent"),
        )
    supplier = tables["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    nation = tables["nation"].select("n_nationkey", "n_name")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("location"),
        F.col("n_name").alias("continent"),
    )


def _profile_key(k: Column) -> Column:
    """The attribute formulas (population, scale, index) use the key modulo 25,
    which is the nation key itself at nation grain."""
    return k % 25


def _between(df: DataFrame, time: str, since: dt.date | None, until: dt.date | None) -> DataFrame:
    """Rows of the days from ``since`` to ``until``. The conditions are on the stored
    column itself, so they reach the scan."""
    if since is not None:
        df = df.where(F.col(time) >= F.lit(dt.datetime.combine(since, dt.time())).cast(df.schema[time].dataType))
    if until is not None:
        after = dt.datetime.combine(until + dt.timedelta(days=1), dt.time())
        df = df.where(F.col(time) < F.lit(after).cast(df.schema[time].dataType))
    return df


def _ordered(tables: Tables, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    return _between(tables["orders"], "o_orderdate", since, until).withColumn("day", F.to_date("o_orderdate"))


def _shipped(tables: Tables, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    return _between(tables["lineitem"], "l_shipdate", since, until).withColumn("day", F.to_date("l_shipdate"))


def fact_days(tables: Tables, since: dt.date | None = None) -> DataFrame:
    """One row: ``ends``, a struct of the first and last day of orders and shipments together."""
    ends = [
        rows.agg(F.min("day").alias("first"), F.max("day").alias("last"))
        for rows in (_ordered(tables, since).select("day"), _shipped(tables, since).select("day"))
    ]
    return ends[0].unionByName(ends[1]).agg(F.struct(F.min("first").alias("first"), F.max("last").alias("last")).alias("ends"))


def calendar(tables: Tables) -> tuple[Column, Column]:
    """First and last day of the panels, from one scalar subquery over a date column of each fact table."""
    ends = fact_days(tables).select("ends").scalar()
    return ends["first"], ends["last"]


def reported_days(
    ent: DataFrame, facts: DataFrame, measures: tuple[str, ...], first: Column, carried: DataFrame | None = None
) -> DataFrame:
    """Daily sums of ``measures`` per entity, with their running totals (``total_<measure>``):
    one row for each day with facts, and one for the day ``first``. Facts of unknown
    entities are dropped.

    ``carried`` (k, total_<measure>) holds the totals of the day before ``first``, which the
    running totals go on from; without it they start at the first report.

    The first days, a row per entity, are the only rows that are added before
    the shuffles; the other days without facts are filled in by ``every_day``.
    """
    totals = [f"total_{m}" for m in measures]
    seeds = ent.select("k", first.alias("date"))
    if carried is not None:
        seeds = seeds.join(carried.select("k", *totals), "k", "left")
    rows = facts.where(F.col("date").isNotNull()).unionByName(seeds, allowMissingColumns=True)
    if carried is None:
        added = {t: F.col(m) for m, t in zip(measures, totals, strict=True)}
        daily = rows.groupBy("k", "date").agg(*[F.sum(m).alias(m) for m in measures])
    else:
        daily = rows.groupBy("k", "date").agg(
            *[F.sum(m).alias(m) for m in measures], *[F.sum(t).alias(t) for t in totals]
        )
        added = {
            t: F.coalesce(F.col(m) + F.col(t), F.col(m), F.col(t)) for m, t in zip(measures, totals, strict=True)
        }
    so_far = Window.partitionBy("k").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.join(ent, "k").select(
        "k", "continent", "location", "date", *measures, *[F.sum(c).over(so_far).alias(t) for t, c in added.items()]
    )


def every_day(days: DataFrame, measures: tuple[str, ...], last: Column) -> DataFrame:
    """Fills in the days up to the entity's next row (or the day ``last``): the
    measures of a day without facts are NULL, all other columns go on as they were."""
    following = F.lead("date").over(Window.partitionBy("k").orderBy("date"))
    filled = days.withColumn("until", F.coalesce(F.date_sub(following, 1), last)).withColumn(
        "day", F.explode(F.sequence("date", "until"))
    )
    own = F.col("day") == F.col("date")
    others = [c for c in days.columns if c not in (*measures, "date")]
    return filled.select(
        *others, F.col("day").alias("date"), *[F.when(own, F.col(m)).alias(m) for m in measures]
    )


def _per_million(col: str) -> Column:
    return F.try_divide(F.col(col).cast("double") * F.lit(1000000), F.col("population"))


def outcome_facts(
    tables: Tables, grain: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """(k, date, new_cases, new_deaths) of every fact from ``since`` to ``until``."""
    if grain == "nation":
        orders = _ordered(tables, since, until).select("o_custkey", "o_totalprice", "o_orderstatus", "day")
        customer = tables["customer"].select("c_custkey", "c_nationkey")
        price, status, day = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("day")
        rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
        key = F.col("c_nationkey")
    else:
        rows = _shipped(tables, since, until).select("l_suppkey", "l_extendedprice", "l_linestatus", "day")
        price, status, day, key = F.col("l_extendedprice"), F.col("l_linestatus"), F.col("day"), F.col("l_suppkey")
    return rows.select(
        key.alias("k"),
        day.alias("date"),
        F.floor(price / 100).alias("new_cases"),
        F.when(status == "F", F.floor(price / 1000)).otherwise(F.lit(0)).alias("new_deaths"),
    )


def coverage_facts(
    tables: Tables, grain: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """(k, date, q, f, b) of every fact from ``since`` to ``until``."""
    lineitem = _shipped(tables, since, until).select("l_suppkey", "l_quantity", "l_returnflag", "day")
    if grain == "nation":
        supplier = tables["supplier"].select("s_suppkey", "s_nationkey")
        lines, key = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey), F.col("s_nationkey")
    else:
        lines, key = lineitem, F.col("l_suppkey")
    qty = F.floor(F.col("l_quantity"))
    flag = F.col("l_returnflag")
    return lines.select(
        key.alias("k"),
        F.col("day").alias("date"),
        qty.alias("q"),
        F.when(flag == "N", qty).otherwise(F.lit(0)).alias("f"),
        F.when(flag == "R", qty).otherwise(F.lit(0)).alias("b"),
    )


def outcome_columns(days: DataFrame) -> DataFrame:
    """The outcomes panel of (k, continent, location, date, measures and totals), a row per entity and day."""
    k = _profile_key(F.col("k"))
    population = (
        F.lit(1000000) * (k + 1)
        + F.when(k % 5 == 0, F.lit(1000) * (F.year("date") - 1995)).otherwise(F.lit(0))
    ).cast("long")
    nations = days.select(
        "continent", "location", "date", population.alias("population"),
        F.col("total_new_cases").alias("total_cases"), "new_cases",
        F.col("total_new_deaths").alias("total_deaths"), "new_deaths",
    )
    regions = nations.groupBy(F.col("continent").alias("location"), "date").agg(
        F.sum("population").alias("population"),
        F.sum("total_cases").alias("total_cases"),
        F.sum("new_cases").alias("new_cases"),
        F.sum("total_deaths").alias("total_deaths"),
        F.sum("new_deaths").alias("new_deaths"),
    ).select(F.lit(None).cast("string").alias("continent"), "*")
    return nations.unionByName(regions).select(
        *DEATHS_COLUMNS[:-2],
        _per_million("new_deaths").alias("new_deaths_per_million"),
        _per_million("total_deaths").alias("total_deaths_per_million"),
    )


def coverage_columns(days: DataFrame) -> DataFrame:
    """The coverage panel of (k, continent, location, date, q, totals, tf), a row per entity
    and day; ``tf`` is the entity's total of f over all days."""
    k = _profile_key(F.col("k"))
    reported = F.col("q").isNotNull()
    rq, rf, rb, tf = F.col("total_q"), F.col("total_f"), F.col("total_b"), F.col("tf")
    scale = F.lit(40) + F.lit(2) * k
    return days.select(
        "continent", "location", "date",
        (F.lit(1000000) * (k + 1)).cast("long").alias("population"),
        F.when(reported, rq).alias("total_vaccinations"),
        F.when(reported, rf + rb).alias("people_vaccinated"),
        F.when(reported, rf).alias("people_fully_vaccinated"),
        F.when(reported, rb).alias("total_boosters"),
        F.col("q").alias("new_vaccinations"),
        F.when(reported, F.try_divide(rf.cast("double") * scale, tf)).alias("people_fully_vaccinated_per_hundred"),
        F.when(reported & (k % 4 != 3), F.try_divide(rb.cast("double") * scale, F.lit(2) * tf))
        .alias("total_boosters_per_hundred"),
        F.when(k % 6 != 5, (F.lit(1000) * (k + 1)).cast("double")).alias("gdp_per_capita"),
        F.when(k % 10 != 9, (F.lit(45) + F.lit(2) * k).cast("double") / F.lit(100)).alias("human_development_index"),
    )


def deaths_panel(spark: SparkSession, root: str, grain: str = "nation", tables: Tables | None = None) -> DataFrame:
    """The outcomes panel (see ``DEATHS_COLUMNS``)."""
    tables = tables or Tables(spark, root)
    first, last = calendar(tables)
    ent = entities(spark, root, grain, tables)
    reported = reported_days(ent, outcome_facts(tables, grain), OUTCOME_MEASURES, first)
    return outcome_columns(every_day(reported, OUTCOME_MEASURES, last))


def vax_panel(spark: SparkSession, root: str, grain: str = "nation", tables: Tables | None = None) -> DataFrame:
    """The coverage panel (see ``VAX_COLUMNS``)."""
    tables = tables or Tables(spark, root)
    first, last = calendar(tables)
    ent = entities(spark, root, grain, tables)
    reported = reported_days(ent, coverage_facts(tables, grain), COVERAGE_MEASURES, first)
    whole = reported.withColumn("tf", F.sum("f").over(Window.partitionBy("k"))).drop("f", "b")
    return coverage_columns(every_day(whole, ("q",), last))
