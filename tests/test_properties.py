"""Property checks on random small panels."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.functions import bands
from panelspark.operators import completeness, rolling

settings.register_profile("spark", deadline=None, max_examples=15,
                          suppress_health_check=[HealthCheck.function_scoped_fixture])
settings.load_profile("spark")

values = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=1000)), min_size=1, max_size=30)


def series(spark, vals):
    base = dt.date(2021, 1, 1)
    rows = [("A", base + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "location string, date date, x long")


@given(values)
def test_rolling_current_row_frame_is_identity(spark, vals):
    df = series(spark, vals).select("x", rolling("x", 0, 0, "avg").alias("m"))
    for r in df.collect():
        assert (r.x is None and r.m is None) or r.m == r.x


@given(values)
def test_completeness_within_bounds(spark, vals):
    out = completeness(series(spark, vals), ["x"]).first()
    assert out.total_rows == len(vals)
    assert out.non_null_count == sum(v is not None for v in vals)
    assert 0.0 <= out.completeness_percentage <= 100.0


@given(st.lists(st.floats(min_value=-10, max_value=120, allow_nan=False), min_size=1, max_size=40))
def test_band_ordinal_is_monotone_in_value(spark, xs):
    b = bands.VACCINATION_PHASES
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", b.ordinal(b.label("x")).alias("o"))
    pairs = sorted((r.x, r.o) for r in df.collect())
    ordinals = [o for _, o in pairs]
    assert ordinals == sorted(ordinals)


@given(st.lists(st.integers(min_value=0, max_value=5), min_size=2, max_size=30))
def test_percent_rank_in_unit_interval(spark, xs):
    from pyspark.sql import Window

    df = spark.createDataFrame([(x,) for x in xs], "x long")
    got = [r.p for r in df.select(F.percent_rank().over(Window.orderBy("x")).alias("p")).collect()]
    assert all(0.0 <= p <= 1.0 for p in got)
