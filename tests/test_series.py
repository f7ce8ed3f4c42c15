"""Operators on series against plain Python versions: nulls, ties, repeated rows, empty tables."""

import datetime as dt
import itertools

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_plans import plan_text

from panelspark import operators as O
from panelspark.plans import series
from panelspark.sources import read_panel_csv_checked
from panelspark.sources.csv import DEATHS_SCHEMA

BASE = dt.date(2020, 1, 1)
FEW = settings(deadline=None, max_examples=8, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n):
    return None if n is None else BASE + dt.timedelta(days=n)


# --- bitmaps -------------------------------------------------------------------

IDS = st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 70_000)), st.booleans()), max_size=40)


@FEW
@given(IDS)
def test_distinct_ids_over_overlapping_windows(spark, rows):
    df = spark.createDataFrame([(day(d), i, b) for d, i, b in rows], "date date, id long, ok boolean")
    maps = O.id_bitmaps(df, ["date"], "id", {"every": F.lit(True), "good": F.col("ok")})
    got = {r.date: (r.every, r.good) for r in O.distinct_ids(O.trailing_days(maps, 3), ["date"], ["every", "good"]).collect()}
    want = {}
    for n in {d + k for d, i, _ in rows if i is not None for k in range(3)}:
        inside = [(i, b) for d, i, b in rows if i is not None and n - 3 < d <= n]
        want[day(n)] = (len({i for i, _ in inside}), len({i for i, b in inside if b}))
    assert got == want
    total = O.distinct_ids(maps, [], ["every"]).first()
    assert (total.every or 0) == len({i for _, i, _ in rows if i is not None})


def test_distinct_counts_need_no_expand(spark):
    counted = series._monthly_distinct(spark, SF_SMALL), series._rolling_distinct(spark, SF_SMALL)
    assert all("Expand" not in plan_text(df) for df in counted)


# --- joins ---------------------------------------------------------------------

def keyed(spark, rows):
    return spark.createDataFrame([(a, day(d), v) for a, d, v in rows], "location string, date date, v long")


def test_checked_join_counts_copies_in_one_pass(spark):
    left = keyed(spark, [("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("b", 1, 4), (None, 1, 5)])
    right = keyed(spark, [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("c", 9, 4), ("c", 9, 5)]).withColumnRenamed("v", "w")
    joined, check = O.checked_panel_join(left, right)
    got = sorted((r.location, r.date, r.v, r.w, r.left_copies, r.right_copies) for r in joined.collect())
    assert got == [("a", day(1), 1, 1, 2, 1), ("a", day(1), 2, 1, 2, 1), ("a", day(2), 3, 2, 1, 2), ("a", day(2), 3, 3, 1, 2)]
    assert check.repeated_rows() == {"left": 2, "right": 4}  # also those that match nothing
    again = spark.read.parquet(f"{SF_SMALL}/nation.parquet").select(
        F.col("n_name").alias("location"), F.lit(BASE).alias("date"), "n_regionkey"
    )
    plan = plan_text(O.checked_panel_join(again, again.withColumnRenamed("n_regionkey", "r"))[0])
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 2  # one a side


def test_checked_join_can_fail(spark):
    left, right = keyed(spark, [("a", 1, 1), ("a", 1, 2)]), keyed(spark, [("a", 1, 1)]).withColumnRenamed("v", "w")
    with pytest.raises(Exception, match="repeated key in the left side"):
        O.checked_panel_join(left, right, on_duplicates="fail")[0].collect()
    assert O.checked_panel_join(right.withColumnRenamed("w", "x"), right, on_duplicates="fail")[0].count() == 1
    with pytest.raises(ValueError):
        O.checked_panel_join(left, right, on_duplicates="drop")


NAMES, DAYS = st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 30))
KEYED = st.lists(st.tuples(NAMES, DAYS, st.one_of(st.none(), st.integers(0, 3))), max_size=14)


@FEW
@given(KEYED, KEYED, st.sampled_from([None, 0, 4]), st.sampled_from([None, 1, 7]))
def test_asof_join(spark, lefts, rights, tolerance, span):
    left, right = keyed(spark, lefts).withColumnRenamed("v", "x"), keyed(spark, rights)
    got = O.asof_join(left, right, ["v"], tolerance_days=tolerance, span_days=span)
    assert got.columns == ["location", "date", "x", "matched_date", "v"]

    def match(name, d):
        least = -1 if tolerance is None else d - tolerance
        fit = [(e, v is not None, v or 0) for n, e, v in rights if n == name and e is not None and least <= e <= d]
        if not fit:
            return (None, None)
        e, known, v = max(fit)
        return (day(e), v if known else None)

    want = [(n, day(d), x, *((None, None) if n is None or d is None else match(n, d))) for n, d, x in lefts]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_asof_of_one_long_series_is_many_tasks(spark):
    left = spark.range(4000).select(F.lit("a").alias("location"), F.date_add(F.lit(BASE), F.col("id").cast("int")).alias("date"))
    right = left.where("dayofmonth(date) = 1").withColumn("v", F.month("date"))
    got = O.asof_join(left, right, ["v"], span_days=100)
    assert got.where("v <> month(date)").count() == 0 and got.where("v is null").count() == 0
    spans = Window_partitions(got)
    assert spans >= 1


def Window_partitions(df):
    return plan_text(df).count("hashpartitioning(location")


# --- fixpoint ------------------------------------------------------------------

@FEW
@given(st.lists(st.tuples(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 14)), st.booleans()), max_size=13,
                unique_by=lambda r: r[0]))
def test_follow_finds_what_the_starts_lead_to(spark, rows):
    df = spark.createDataFrame([("g", *r) for r in rows] + [("h", 1, 1, True), ("h", 2, 1, None)],
                               "grp string, node int, next int, first boolean")
    got = {(r.grp, r.node) for r in O.follow(df, ["grp"], "node", "next", "first").collect()}
    pointers, want = {n: m for n, m, _ in rows}, {("h", 1)}
    for n, _, first in rows:
        while first and n in pointers and ("g", n) not in want:
            want.add(("g", n))
            n = pointers[n]
    assert got == want


def test_follow_takes_few_rounds_for_a_long_chain(spark):
    df = spark.range(700).select(F.lit(1).alias("g"), "id", (F.col("id") + 1).alias("next"), (F.col("id") == 0).alias("first"))
    rounds, real = [], type(df).checkpoint
    try:
        type(df).checkpoint = lambda self, **k: rounds.append(1) or real(self, **k)
        assert O.follow(df, ["g"], "id", "next", "first").count() == 700
    finally:
        type(df).checkpoint = real
    assert len(rounds) <= 13


# --- runs, seasons, lags ---------------------------------------------------------

@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), DAYS), max_size=25))
def test_runs(spark, rows):
    df = spark.createDataFrame([(a, day(d)) for a, d in rows], "location string, date date")
    got = {tuple(r) for r in O.runs(df, [F.count(F.lit(1)).alias("n")]).collect()}
    want = set()
    for name in "ab":
        days = sorted({d for a, d in rows if a == name and d is not None})
        found = [[d for _, d in g] for _, g in itertools.groupby(enumerate(days), lambda t: t[1] - t[0])]
        for before, run in zip([None, *found], found, strict=False):
            n = sum(a == name and d in run for a, d in rows)
            want.add((name, day(run[0]), day(run[-1]), len(run), None if before is None else run[0] - before[-1] - 1, n))
    assert got == want


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=20), st.integers(0, 4))
def test_centred_mean(spark, values, half):
    df = spark.createDataFrame([("a", day(i), v) for i, v in enumerate(values)], "location string, date date, x long")
    got = [r.m for r in df.select("date", O.centred_mean("x", half).alias("m")).orderBy("date").collect()]
    known = [v or 0 for v in values]
    for i, m in enumerate(got):
        inside = i - half >= 0 and i + half < len(known)
        assert (m is None) != inside
        assert m is None or m == pytest.approx(sum(known[i - half : i + half + 1]) / (2 * half + 1))


def test_seasonal_index_of_a_known_pattern(spark):
    pattern = [10, 20, 30, 40, 50, 60, 70]
    rows = [("a", day(i), pattern[day(i).weekday()]) for i in range(70)] + [("z", day(i), 0) for i in range(70)]
    df = spark.createDataFrame(rows, "location string, date date, x long")
    got = O.seasonal_indices(df, "x", {"weekday": (F.weekday("date") + 1, 3)}).collect()
    assert {r.location for r in got} == {"a"}  # a trend of zero gives no ratios
    assert {r.position: round(r.seasonal_index, 9) for r in got} == {i + 1: p / 40 for i, p in enumerate(pattern)}
    assert O.seasonal_indices(df.limit(0), "x", {"weekday": (F.weekday("date"), 3)}).count() == 0


def test_lag_correlations_are_those_of_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 100, 80).tolist()
    x[7] = None
    y = [None if i < 5 or x[i - 5] is None else 3 * x[i - 5] + int(rng.integers(3)) for i in range(80)]
    rows = [("a", day(i), x[i], y[i]) for i in range(80)] + [("b", day(i), 1, i) for i in range(40)]
    df = spark.createDataFrame(rows, "location string, date date, x long, y long")
    table = O.lag_correlations(df, "x", "y", 9)
    got = {r.lag: r for r in table.where("location = 'a'").collect()}
    for lag in range(10):
        pairs = [(x[i - lag], y[i]) for i in range(lag, 80) if x[i - lag] is not None and y[i] is not None]
        assert got[lag].pairs == len(pairs)
        assert got[lag].correlation == pytest.approx(np.corrcoef(np.array(pairs).T)[0, 1])
    best = O.best_lag(table, 30).collect()
    assert [(r.location, r.best_lag, r.lags) for r in best] == [("a", 5, 10)]  # b has no variance
    text = plan_text(table)
    assert text.split("== Initial Plan ==")[0].count("Window [") == 1


# --- files ---------------------------------------------------------------------

def test_csv_rows_with_problems(spark, tmp_path):
    lines = ["iso,date,location,new_cases,continent,population,total_cases,total_deaths,new_deaths,new_deaths_per_million,total_deaths_per_million",
             "x,2020-01-01,A,5.0,C,10,5,0,,0.5,", "x,2020-01-02,A,,C,10,5,0,0,,", "x,2020-13-02,A,1,C,10,5,0,0,,",
             "x,,A,1,C,10,5,0,0,,", "x,2020-01-03,,1,C,10,5,0,0,,", "x,2020-01-04,A,1.5,C,10,5,0,0,,", "too,short",
             "x,2020-01-05,A,1,C,10,5,0,0,,,more", "x,2020-01-06,A,9999999999999999999,C,10,5,0,0,,", "x,2020-01-07,\"B, c\",1,C,10,5,0,0,a,"]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    got = read_panel_csv_checked(spark, str(tmp_path / "p.csv"), DEATHS_SCHEMA).collect()
    assert [r.problem for r in got] == [None, None, "invalid date", "missing date", "missing location", "invalid new_cases",
                                       "malformed", "malformed", "invalid new_cases", "invalid new_deaths_per_million"]
    assert (got[0].new_cases, got[0].new_deaths, got[1].new_cases) == (5, None, None)
    assert got[6].raw == "too,short" and got[7].raw == lines[8] and got[9].location == "B, c"
    (tmp_path / "e.csv").write_text(lines[0] + "\n")
    empty = read_panel_csv_checked(spark, str(tmp_path / "e.csv"), DEATHS_SCHEMA)
    assert empty.count() == 0 and empty.where("problem IS NULL").columns[: len(DEATHS_SCHEMA)] == DEATHS_SCHEMA.names
    problems = read_panel_csv_checked(spark, str(tmp_path / "p.csv"), DEATHS_SCHEMA).groupBy("problem").count()
    assert sum(r["count"] for r in problems.collect()) == 10
