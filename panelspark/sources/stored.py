"""Panels kept as tables, partitioned by date and refreshed from a day on.

A stored panel holds a row per entity and day: the day's sums and the running
totals up to it, in a partition per day (or week, month, quarter, where a day's
rows are few). When facts of some days arrive, the partitions from the first of
them on are derived again and overwritten; the running totals go on from the
stored day before. So a refresh reads the facts of those days, one partition of the
table and the small entity tables, whatever the table's age, and it may be run again
after a failure: the day it goes on from is never written by it.

Beside the rows stands a table of the stored days, a row per day, from which the
latest day is found without a look at the panel. Filters on the partition, also
those that compare it with a scalar subquery, prune.

Facts are skipped by file statistics, or by partition where the base tables have a day
partition; Spark's reader has no statistics filter for timestamps without time zone, of which
the rows of other days are read and dropped in the scan.

Entities that are new since the build come in from the refreshed day on; ``build`` gives
them all days. What depends on all of an entity's days or can be computed from a row (percentages, rates, the rows
of whole regions) is not stored: a refresh would have to rewrite every day for it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.sources import panels
from panelspark.sources.tables import Tables

#: Spans of a partition.
SPANS = ("day", "week", "month", "quarter")

#: Kinds of stored panels: their daily measures, and those whose daily value is kept beside the total.
KINDS = {
    "outcomes": (panels.OUTCOME_MEASURES, panels.OUTCOME_MEASURES),
    "coverage": (panels.COVERAGE_MEASURES, ("q",)),
}


class StoredPanel:
    """A panel of ``kind`` ("outcomes" or "coverage") under ``path``, derived from the base tables in ``root``."""

    def __init__(
        self, spark: SparkSession, path: str, root: str, kind: str = "outcomes", grain: str = "nation", span: str = "day"
    ):
        if kind not in KINDS or span not in SPANS:
            raise ValueError(f"kind is one of {tuple(KINDS)}, span one of {SPANS}; got {kind!r}, {span!r}")
        self.span = span
        self.spark, self.path, self.root, self.kind, self.grain = spark, path.rstrip("/"), root, kind, grain
        self.measures, self.kept = KINDS[kind]

    @property
    def schema(self) -> T.StructType:
        key = T.IntegerType() if self.grain == "nation" else T.LongType()
        numbers = [*self.kept, *[f"total_{m}" for m in self.measures]]
        return T.StructType(
            [T.StructField("k", key), T.StructField("continent", T.StringType()), T.StructField("location", T.StringType())]
            + [T.StructField(n, T.LongType()) for n in numbers]
            + [T.StructField("date", T.DateType()), T.StructField("part", T.DateType())]
        )

    def part_of(self, date: Column) -> Column:
        """The partition of a day: the first day of its span."""
        return date if self.span == "day" else F.trunc(date, self.span)

    def _first_of(self, day: dt.date) -> dt.date:
        if self.span == "week":
            return day - dt.timedelta(days=day.weekday())
        months = {"month": 1, "quarter": 3}.get(self.span)
        return day.replace(month=day.month - (day.month - 1) % months, day=1) if months else day

    # --- reading ---------------------------------------------------------

    def rows(self) -> DataFrame:
        """The stored rows; ``part`` is the partition column."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def days(self) -> DataFrame:
        """(date, entities, reports) of every stored day."""
        return self.spark.read.schema("date date, entities long, reports long").parquet(f"{self.path}/days")

    def on(self, day: Column) -> DataFrame:
        """The rows of one day, from its partition only; ``day`` may be a scalar subquery."""
        return self.rows().where((F.col("part") == self.part_of(day)) & (F.col("date") == day))

    def latest(self) -> DataFrame:
        """The rows of the latest day: one partition, picked by a scalar subquery on the days."""
        return self.on(self.days().select(F.max("date")).scalar())

    def panel(self, rows: DataFrame | None = None) -> DataFrame:
        """The panel's columns of ``rows`` (all stored rows by default)."""
        rows = self.rows() if rows is None else rows
        if self.kind == "outcomes":
            return panels.outcome_columns(rows)
        whole = self.latest().select("k", F.col("total_f").alias("tf"))
        return panels.coverage_columns(rows.join(whole, "k"))

    # --- writing ---------------------------------------------------------

    def derived(self, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """The rows of the days from ``since`` on, going on from the stored totals of the day before.

        Without ``since``: of all days. ``until`` is the last day, that of the facts (and of
        the stored days) by default."""
        tables = Tables(self.spark, self.root)
        found = panels.fact_days(tables, since).first()["ends"]
        first = since or found["first"]
        last = until or max([d for d in (found["last"], self._last_stored() if since else None) if d], default=None)
        if first is None or last is None or last < first:
            return self.spark.createDataFrame([], self.schema)
        carried = None
        if since:
            carried = self.on(F.lit(since - dt.timedelta(days=1)))
        facts = panels.outcome_facts if self.kind == "outcomes" else panels.coverage_facts
        reported = panels.reported_days(
            panels.entities(self.spark, self.root, self.grain, tables),
            facts(tables, self.grain, since, last), self.measures, F.lit(first), carried,
        )
        dropped = [m for m in self.measures if m not in self.kept]
        filled = panels.every_day(reported.drop(*dropped), self.kept, F.lit(last))
        return filled.withColumn("part", self.part_of(F.col("date"))).select(*self.schema.names)

    def build(self, until: dt.date | None = None) -> None:
        """Writes the whole panel anew, up to the day ``until``."""
        self._write(self.derived(until=until), None)

    def refresh(self, since: dt.date, until: dt.date | None = None) -> None:
        """Derives and overwrites the days from ``since`` on, the first day that new facts touch.

        The days begin with their partition. Where no stored day is before them, all is built anew."""
        first = self.days().agg(F.min("date")).first()[0]
        since = self._first_of(min(since, (self._last_stored() or since) + dt.timedelta(days=1)))
        if first is None or since <= first:
            return self.build(until)
        self._write(self.derived(since, until), since)

    def first_touched(self, facts: DataFrame, time: str) -> dt.date | None:
        """The day from which on a refresh is needed for ``facts``, None if there are none."""
        return facts.agg(F.min(F.to_date(time))).first()[0]

    def _last_stored(self) -> dt.date | None:
        return self.days().agg(F.max("date")).first()[0]

    def _write(self, rows: DataFrame, since: dt.date | None) -> None:
        """Replaces the partitions that ``rows`` has (all, if ``since`` is None), when all tasks are done."""
        mode = "dynamic" if since else "static"
        (
            rows.repartition("part").sortWithinPartitions("part", "date", "k")
            .write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("part").parquet(f"{self.path}/rows")
        )
        kept, written = [], self.rows()
        if since:  # a row per calendar day: few, whatever the number of facts and entities
            kept = self.days().where(F.col("date") < F.lit(since)).collect()
            written = written.where(F.col("part") >= F.lit(since))
        counted = written.groupBy("date").agg(F.count(F.lit(1)).alias("entities"), F.count(self.kept[0]).alias("reports"))
        before = self.spark.createDataFrame(kept, counted.schema)
        before.unionByName(counted).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/days")
