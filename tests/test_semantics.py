"""Hand-made micro panels for the semantic corner cases of the jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.functions import bands
from panelspark.functions.ratios import growth_pct, pct_ratio
from panelspark.operators import (
    crossings,
    duplicate_keys,
    global_row_number,
    latest_per_entity,
    panel_join,
    rolling,
    rows_at_entity_latest,
)
from panelspark.plans import exploration as ex
from panelspark.plans import global_analysis as ga
from panelspark.plans import vaccination as vx
from panelspark.sources.csv import DEATHS_SCHEMA, VAX_SCHEMA

D0 = dt.date(2021, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def deaths(spark, rows):
    """rows: dicts with any subset of the deaths columns."""
    names = DEATHS_SCHEMA.fieldNames()
    defaults = {"continent": "C", "population": 1000}
    data = [tuple({**defaults, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, DEATHS_SCHEMA)


def vax(spark, rows):
    names = VAX_SCHEMA.fieldNames()
    defaults = {"continent": "C", "population": 1000}
    data = [tuple({**defaults, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, VAX_SCHEMA)


def test_zero_denominator_gives_null_not_error(spark):
    df = deaths(spark, [{"location": "A", "date": day(0), "population": 0, "total_cases": 0, "total_deaths": 0}])
    row = df.select(pct_ratio("total_cases", "population", 2).alias("r"),
                    growth_pct("total_cases", F.lit(0)).alias("g")).first()
    assert row.r is None and row.g is None
    summary = ex.latest_summary(df).first()
    assert summary.global_infection_rate_percent is None
    assert summary.global_case_fatality_rate_percent is None


def test_empty_input(spark):
    empty = deaths(spark, [])
    assert ex.group_distribution(empty).count() == 0
    assert ga.global_trend(empty, "2020-01-01").count() == 0
    one = ex.latest_summary(empty).collect()
    assert len(one) == 1 and one[0].total_countries == 0 and one[0].total_cases is None


def test_null_group_rows_are_dropped(spark):
    df = deaths(spark, [
        {"continent": None, "location": "World", "date": day(0), "new_cases": 999, "total_cases": 999},
        {"location": "A", "date": day(0), "new_cases": 1, "total_cases": 1},
    ])
    out = ex.dataset_overview(df, vax(spark, []))
    assert [r.total_records for r in out.orderBy("dataset_name").collect()] == [1, 0]


def test_null_orders_first_in_percent_rank(spark):
    # group Z has no positive population at the latest date -> NULL mean rate
    df = deaths(spark, [
        {"continent": "X", "location": "A", "date": day(0), "population": 100, "total_cases": 10, "total_deaths": 1},
        {"continent": "Y", "location": "B", "date": day(0), "population": 100, "total_cases": 20, "total_deaths": 1},
        {"continent": "Z", "location": "C", "date": day(0), "population": 0, "total_cases": 5, "total_deaths": 1},
    ])
    out = {r.continent: r for r in ga.group_percentiles(df).collect()}
    assert out["Z"].avg_infection_rate is None
    assert out["Z"].infection_rate_percentile == 0.0
    assert out["X"].infection_rate_percentile == 50.0
    assert out["Y"].infection_rate_percentile == 100.0


def test_ties_at_rank_k_are_broken_by_entity(spark):
    rows = [{"location": f"L{i:02d}", "date": day(0), "total_cases": 100, "total_deaths": 10} for i in range(25)]
    out = ga.entity_rankings(deaths(spark, rows), k=20).collect()
    assert len(out) == 20
    assert [r.location for r in out] == [f"L{i:02d}" for i in range(20)]
    assert [r.rank_by_total_cases for r in out] == list(range(1, 21))


def test_rank_one_ties_keep_every_peak_day(spark):
    rows = [
        {"location": "A", "date": day(0), "new_cases": 5, "new_deaths": 2},
        {"location": "A", "date": day(1), "new_cases": 5, "new_deaths": 1},
        {"location": "A", "date": day(2), "new_cases": 3, "new_deaths": 1},
    ]
    out = ga.peak_days(deaths(spark, rows)).orderBy("date").collect()
    assert [(r.date, r.case_rank, r.death_rank) for r in out] == [(day(0), 1, 1), (day(1), 1, 2)]
    assert out[1].death_peak_status == bands.NOT_PEAK


def test_frames_count_rows_not_days(spark):
    # a gap of 10 days inside the series: the 7-row frame still reaches back over it
    rows = [{"location": "A", "date": day(i), "new_cases": 1} for i in range(3)]
    rows += [{"location": "A", "date": day(i), "new_cases": 100} for i in range(13, 16)]
    df = deaths(spark, rows).select(
        "date", rolling("new_cases", -6, 0, "avg").alias("by_rows"),
        rolling("new_cases", -6, 0, "avg", by_days=True).alias("by_days"),
    )
    last = df.orderBy(F.col("date").desc()).first()
    assert last.by_rows == pytest.approx((3 * 1 + 3 * 100) / 6)
    assert last.by_days == pytest.approx(100.0)


def test_single_row_frame_std_is_zero_population(spark):
    rows = [{"location": "A", "date": day(0), "new_cases": 10}, {"location": "A", "date": day(1), "new_cases": 11}]
    out = ex.rolling_outliers(deaths(spark, rows)).collect()
    # std of one previous value is 0 with the population formula, so 11 > 10 + 0 is an outlier
    assert [(r.new_cases, r.std_7day_cases, r.outlier_status) for r in out] == [(11, 0.0, bands.OUTLIER_HIGH)]
    assert ex.rolling_outliers(deaths(spark, rows), ddof=1).count() == 0


@pytest.mark.parametrize("banding,value,expected", [
    (bands.VACCINATION_PHASES, 10.0, "Early Vaccination (10-30%)"),
    (bands.VACCINATION_PHASES, 9.999, "Pre-Vaccination (<10%)"),
    (bands.VACCINATION_PHASES, None, "Full Vaccination (>70%)"),
    (bands.VACCINATION_LEVELS, 50.0, "Medium Vaccination (30-50%)"),
    (bands.VACCINATION_LEVELS, 50.01, "High Vaccination (>50%)"),
    (bands.BOOSTER_LEVELS, None, "Minimal Booster Coverage (<5%)"),
    (bands.DEVELOPMENT_LEVELS, 0.8, "Very High Development"),
    (bands.DEVELOPMENT_LEVELS, 0.55, "Medium Development"),
    (bands.DEVELOPMENT_LEVELS, 0.5499, "Low Development"),
    (bands.GROWTH_PHASES, 1000000.0, "Massive Outbreak (>1M cases)"),
    (bands.GROWTH_PHASES, 99.0, "Initial Phase (<100 cases)"),
])
def test_band_edges_and_null(spark, banding, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(banding.label("x").alias("b")).first().b == expected


def test_milestones_first_arm_recrossing_and_first_row(spark):
    cov = "people_fully_vaccinated_per_hundred"
    series = {
        "jump": [5, 35, 40],           # 5 -> 35 records only the 10 % arm
        "recross": [9, 11, 9, 11],     # crosses 10 % twice
        "starts_high": [12, 31],       # first row has no previous value
    }
    rows = [{"location": loc, "date": day(i), cov: float(v)} for loc, vals in series.items() for i, v in enumerate(vals)]
    marked = crossings(vax(spark, rows), cov, bands.MILESTONES).where(F.col("milestone_reached").isNotNull())
    got = sorted((r.location, r.date, r.milestone_reached) for r in marked.collect())
    assert got == [
        ("jump", day(1), "10% Milestone"),
        ("recross", day(1), "10% Milestone"),
        ("recross", day(3), "10% Milestone"),
        ("starts_high", day(1), "30% Milestone"),
    ]
    timeline = {r.location: r for r in vx.milestone_timeline(vax(spark, rows)).collect()}
    # only entities with both 10 % and 30 % dates are reported
    assert set(timeline) == set()
    rows.append({"location": "recross", "date": day(4), cov: 30.0})
    timeline = {r.location: r for r in vx.milestone_timeline(vax(spark, rows)).collect()}
    assert timeline["recross"].reached_10_percent == day(3)  # the last crossing wins
    assert timeline["recross"].days_10_to_30_percent == 1
    first = {r.location: r for r in vx.milestone_timeline(vax(spark, rows), crossing="first").collect()}
    assert first["recross"].reached_10_percent == day(1)
    assert first["recross"].days_10_to_30_percent == 3


def test_duplicate_keys_fan_out_and_latest(spark):
    d = deaths(spark, [
        {"location": "A", "date": day(0), "new_cases": 1},
        {"location": "A", "date": day(0), "new_cases": 2},
    ])
    v = vax(spark, [{"location": "A", "date": day(0), "people_fully_vaccinated_per_hundred": 5.0}])
    assert duplicate_keys(d).first().copies == 2
    assert panel_join(v.select("location", "date"), d.select("location", "date", "new_cases")).count() == 2
    assert latest_per_entity(d).count() == 1
    assert rows_at_entity_latest(d).count() == 2


def test_inequality_uses_latest_reported_date_per_entity(spark):
    cov = "people_fully_vaccinated_per_hundred"
    rows = [
        {"location": "A", "date": day(0), cov: 10.0, "human_development_index": 0.9, "gdp_per_capita": 1.0},
        {"location": "A", "date": day(1), cov: 20.0, "human_development_index": 0.9, "gdp_per_capita": 1.0},
        {"location": "A", "date": day(2), cov: None, "human_development_index": 0.9},
        # B's latest reported row has no index: B drops out instead of falling back
        {"location": "B", "date": day(0), cov: 30.0, "human_development_index": 0.9},
        {"location": "B", "date": day(1), cov: 40.0, "human_development_index": None},
    ]
    out = vx.inequality(vax(spark, rows)).collect()
    assert [(r.countries_count, r.avg_vaccination_rate, r.vaccination_std_dev) for r in out] == [(1, 20.0, 0.0)]


def test_global_row_number_matches_single_partition_window(spark):
    import random

    rnd = random.Random(7)
    data = [(i, rnd.randint(0, 20)) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, v long").repartition(13)
    got = global_row_number(df, [F.col("v").desc(), F.col("id")], "pos", partitions=5)
    expected = sorted(data, key=lambda t: (-t[1], t[0]))
    assert [(r.id, r.pos) for r in got.orderBy("pos").collect()] == [(t[0], i + 1) for i, t in enumerate(expected)]


def test_lag_vs_lead_direction(spark):
    rows = [{"location": "A", "date": day(i), "new_cases": 1, "new_deaths": i + 1} for i in range(40)]
    lag = ga.lagged_association(deaths(spark, rows), shift=14, min_points=1).first()
    lead = ga.lagged_association(deaths(spark, rows), shift=14, min_points=1, direction="lead").first()
    # lag keeps rows 15..40 and reads deaths 1..26; lead keeps rows 1..26 and reads 15..40
    assert lag.avg_deaths_14_days_later == round(sum(range(1, 27)) / 26)
    assert lead.avg_deaths_14_days_later == round(sum(range(15, 41)) / 26)


def test_mean_of_rounded_resolves_exact_ties_half_up(spark):
    from panelspark.functions.ratios import mean_of_rounded

    df = spark.createDataFrame([(34.4,), (34.5,)], "x double")
    assert df.agg(mean_of_rounded("x", 1).alias("m")).first().m == 34.5
    days = spark.createDataFrame([(d,) for d in [123] * 11 + [124] * 9], "d long")  # mean 123.45
    assert days.agg(mean_of_rounded("d", 1).alias("m")).first().m == 123.5


def test_index_is_averaged_before_it_is_rounded(spark):
    cov = "people_fully_vaccinated_per_hundred"
    rows = [{"location": x, "date": day(0), cov: 10.0, "human_development_index": h}
            for x, h in (("A", 0.8004), ("B", 0.8004), ("C", 0.8008))]
    assert vx.inequality(vax(spark, rows)).first().avg_hdi == 0.801


def test_positions_match_row_numbers(spark):
    import random

    from pyspark.sql import Window

    from panelspark.operators import positions_of

    rnd = random.Random(11)
    data = [(f"e{i:04d}", rnd.randint(0, 9), rnd.choice([None, 0.5, 1.5, 2.5])) for i in range(500)]
    df = spark.createDataFrame(data, "name string, a long, b double").repartition(7)
    chosen = df.where(F.col("name").isin("e0000", "e0123", "e0499", "e0250"))
    got = positions_of(chosen, df, "name", [("by_a", "a"), ("by_b", "b")])
    numbered = df.select(
        "name",
        *[F.row_number().over(Window.orderBy(F.col(c).desc_nulls_last(), "name")).alias(f"by_{c}") for c in "ab"],
    ).join(chosen.select("name"), "name")
    pick = lambda d: sorted((r[0], r.by_a, r.by_b) for r in d.select(F.col("name"), "by_a", "by_b").collect())
    assert [tuple(r) for r in pick(got)] == [tuple(r) for r in pick(numbered)]
    assert positions_of(chosen.limit(0), df, "name", [("by_a", "a")]).count() == 0


def test_latest_aggregates_leave_out_groups_without_the_last_day(spark):
    from panelspark.operators import aggregate_latest

    rows = [{"location": "A", "date": day(0), "continent": "X", "new_cases": 1},
            {"location": "A", "date": day(1), "continent": "X", "new_cases": 2},
            {"location": "B", "date": day(0), "continent": "Y", "new_cases": 4}]
    df = deaths(spark, rows)
    total = [F.sum("new_cases").alias("c"), F.count("*").alias("n")]
    assert [tuple(r) for r in aggregate_latest(df, total, by=["continent"]).collect()] == [("X", 2, 1)]
    assert tuple(aggregate_latest(df, total).first()) == (2, 1)


def test_correlation_without_variance_is_null(spark):
    from panelspark.functions.ratios import correlation

    rows = [("a", 1, 5), ("a", 2, 5), ("b", 1, 2), ("b", 2, 4), ("b", 3, None), ("b", 4, 8), ("c", None, 1)]
    df = spark.createDataFrame(rows, "g string, x long, y long")
    got = {r.g: r.c for r in df.groupBy("g").agg(F.round(correlation("x", "y"), 9).alias("c")).collect()}
    assert got == {"a": None, "b": 1.0, "c": None}
