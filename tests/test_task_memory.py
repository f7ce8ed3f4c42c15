"""What a task must hold: steps that must not sort, or keep apart, what they can sum up in place."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_plans import plan_text

from panelspark import operators as O
from panelspark.plans import exploration as ex
from panelspark.plans import global_analysis as ga
from panelspark.sources.panels import deaths_panel

D0 = dt.date(2021, 1, 1)


def day(i):
    return None if i is None else D0 + dt.timedelta(days=i)


def rows(spark, data):
    return spark.createDataFrame([(g, e, day(d), v) for g, e, d, v in data], "g string, e string, date date, v long")


def test_distinct_entities_at_the_latest_date(spark):
    df = rows(spark, [("x", "a", 0, 1), ("x", "a", 1, 2), ("x", "a", 1, 3), ("x", None, 1, 4), ("x", "b", 0, 5),
                      ("y", "c", 1, 0), ("y", "d", 1, 7), ("z", "e", 0, 1), ("x", "f", None, 1)])
    seen = ("n", F.when(F.col("v") > 0, F.col("e")))
    got = O.aggregate_latest(df, [F.sum("v").alias("s"), F.count("*").alias("c")], by=["g"], distinct=seen)
    assert sorted(map(tuple, got.collect())) == [("x", 1, 9, 3), ("y", 1, 7, 2)]
    assert tuple(O.aggregate_latest(df, [F.sum("v").alias("s")], distinct=seen).first()) == (2, 16)
    assert O.aggregate_latest(df.limit(0), [F.sum("v").alias("s")], distinct=seen).count() == 1


def test_latest_jobs_keep_no_row_per_entity_and_day(spark):
    for job in (ex.latest_summary, ga.group_percentiles):
        plan = plan_text(job(deaths_panel(spark, SF_SMALL, "supplier"))).replace("partial_", "")
        assert "count(location" not in plan.replace("distinct ", "") and "count(CASE WHEN (total_cases" not in plan


def test_rankings_do_not_sort_the_panel(spark):
    plan = plan_text(ga.entity_rankings(deaths_panel(spark, SF_SMALL, "supplier")))
    assert "min_by(population" in plan  # of numbers, in a hash table
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "name string, v long")
    found = O.positions_of(df.where("name <> 'a'"), df, "name", [("place", "v")])
    assert "SortAggregate(key" not in plan_text(found)
    assert sorted((r.name, r.place) for r in found.collect()) == [("b", 1), ("c", 3)]


def test_bitmaps_are_summed_in_place(spark):
    ids = [-70_000, -1, 0, 63, 64, 32_768, 2**40, None]
    df = spark.createDataFrame([(i, n % 2 == 0) for n, i in enumerate(ids)], "id long, ok boolean").withColumn("k", F.lit(1))
    maps = O.id_bitmaps(df.unionByName(df), ["k"], "id", {"every": F.lit(True), "good": F.col("ok")})
    assert "SortAggregate" not in plan_text(maps)
    found = O.distinct_ids(maps, ["k"], ["every", "good"])
    assert tuple(found.first()) == (1, 7, 4)
    none = O.id_bitmaps(df, ["k"], "id", {"good": F.lit(False)})
    assert [(r.bucket, r.good) for r in none.collect()] == [(0, 0)]  # the group stays


def test_runs_sort_once(spark):
    df = rows(spark, [("x", "a", d, 1) for d in (0, 1, 1, 4, 4, 5, 9, None)] + [("x", None, 3, 1), ("x", None, 5, 2)])
    found = O.runs(df, [F.sum("v").alias("s")], "e")
    assert plan_text(found).split("== Initial Plan ==")[-1].count("Sort [") == 1
    got = sorted(((r.e or ""), (r.run_start - D0).days, (r.run_end - D0).days, r.days, r.gap_before, r.s)
                 for r in found.collect())
    assert got == [("", 3, 3, 1, None, 1), ("", 5, 5, 1, 1, 2), ("a", 0, 1, 2, None, 3), ("a", 4, 5, 2, 2, 3),
                   ("a", 9, 9, 1, 3, 1)]
