"""Stored panels: refreshed from the touched day on, pruned by partition, equal to a full build."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_plans import executed_nodes, rows_read

from panelspark.plans import exploration as ex
from panelspark.sources import StoredPanel, deaths_panel, vax_panel

DAY = dt.datetime(2001, 1, 1)


def at(day):
    return DAY + dt.timedelta(days=day)


def write(spark, folder, name, rows, schema, mode="append"):
    """A file for each day, as daily loads leave them."""
    df = spark.createDataFrame(rows, schema)
    time = next((f.name for f in df.schema if f.dataType.typeName().startswith("timestamp")), None)
    df = df.repartition(40, time).sortWithinPartitions(time) if time else df.coalesce(1)
    df.write.mode(mode).parquet(f"{folder}/{name}.parquet")


def orders(spark, folder, days, factor=1):
    rows = [(d * 10 + i, i % 3, "FO"[i % 2], 1000.0 * factor * (d + i + 1), at(d)) for d in days for i in range(4)]
    write(spark, folder, "orders", rows,
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp")


def lines(spark, folder, days):
    rows = [(d * 10 + i, i % 2, float(d + i + 1), 100.0 * (i + 1), "NRA"[(d + i) % 3], "F", at(d)) for d in days for i in range(3)]
    write(spark, folder, "lineitem", rows, "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
          "l_returnflag string, l_linestatus string, l_shipdate timestamp")


@pytest.fixture(autouse=True)
def timestamps_with_statistics(spark):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    yield
    spark.conf.unset("spark.sql.parquet.outputTimestampType")


@pytest.fixture
def base(spark, tmp_path):
    folder = str(tmp_path / "base")
    write(spark, folder, "region", [(0, "R0"), (1, "R1")], "r_regionkey int, r_name string")
    write(spark, folder, "nation", [(i, f"N{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int")
    write(spark, folder, "customer", [(i, i) for i in range(3)], "c_custkey long, c_nationkey int")
    write(spark, folder, "supplier", [(i, f"S{i}", i + 1) for i in range(2)], "s_suppkey long, s_name string, s_nationkey int")
    orders(spark, folder, [0, 1, 4, 7, 20, 21])
    lines(spark, folder, [2, 3, 9, 22])
    return folder


def full(spark, base, kind, grain):
    return (deaths_panel if kind == "outcomes" else vax_panel)(spark, base, grain)


def same(a, b):
    rows = lambda df: sorted(map(repr, df.select(*b.columns).collect()))
    return rows(a) == rows(b)


@pytest.mark.parametrize("kind, grain, span", [
    ("outcomes", "nation", "day"), ("coverage", "nation", "week"), ("outcomes", "supplier", "month"), ("coverage", "supplier", "quarter")
])
def test_refresh_equals_a_full_build(spark, base, tmp_path, kind, grain, span):
    store = StoredPanel(spark, str(tmp_path / "store"), base, kind, grain, span)
    store.build()
    assert same(store.panel(), full(spark, base, kind, grain))
    orders(spark, base, [20, 23, 40], factor=3)  # a stored day, the day after the last, and one behind a gap
    lines(spark, base, [22, 33])
    store.refresh(at(20).date())
    assert same(store.panel(), full(spark, base, kind, grain))
    store.refresh(at(20).date())  # as after a failure
    assert same(store.panel(), full(spark, base, kind, grain))
    assert store.days().count() == 41 == store.rows().select("date").distinct().count()


def test_late_and_earlier_facts(spark, base, tmp_path):
    store = StoredPanel(spark, str(tmp_path / "store"), base)
    store.build()
    orders(spark, base, [5], factor=7)
    new = spark.read.parquet(f"{base}/orders.parquet").where(F.col("o_totalprice") >= 42000)
    assert store.first_touched(new, "o_orderdate") == at(5).date()
    store.refresh(at(5).date())
    assert same(store.panel(), deaths_panel(spark, base))
    orders(spark, base, [-3])  # before the first stored day: all totals change
    store.refresh(at(-3).date())
    assert same(store.panel(), deaths_panel(spark, base))
    assert store.days().agg(F.min("date")).first()[0] == at(-3).date()


def test_refresh_behind_unstored_days(spark, base, tmp_path):
    store = StoredPanel(spark, str(tmp_path / "store"), base, "coverage")
    store.build(until=at(8).date())
    store.refresh(at(15).date())  # days 9 to 14 are not stored yet, so it starts with them
    assert same(store.panel(), vax_panel(spark, base))


def test_refresh_reads_only_the_touched_days(spark, base, tmp_path):
    store = StoredPanel(spark, str(tmp_path / "store"), base)
    store.build()
    orders(spark, base, [21, 22], factor=2)
    days = store.derived(since=at(21).date())
    assert {r.date for r in days.collect()} == {at(21).date(), at(22).date()}
    scans = [(n.schema().simpleString(), n.metrics()) for kind, n in executed_nodes(days) if kind == "FileSourceScanExec"]
    facts = [m.apply("numOutputRows").value() for s, m in scans if "o_totalprice" in s]
    assert facts == [4 + 4 + 4]  # of 32 orders, those of the days 21 and 22, old and new
    stored = [m for s, m in scans if "total_new_cases" in s]
    assert [m.apply("numOutputRows").value() for m in stored] == [4]  # the four entities on day 20
    assert [m.apply("numPartitions").value() for m in stored] == [1]


def test_latest_day_is_one_partition_picked_by_a_subquery(spark, base, tmp_path):
    store = StoredPanel(spark, str(tmp_path / "store"), base)
    store.build()
    latest = store.latest()
    assert "Subquery" in latest._jdf.queryExecution().executedPlan().toString()
    assert latest.count() == 4
    latest.collect()
    scan = next(n for kind, n in executed_nodes(latest) if kind == "FileSourceScanExec" and "location" in n.schema().simpleString())
    assert scan.metrics().apply("numPartitions").value() == 1 and scan.metrics().apply("numOutputRows").value() == 4
    got = ex.latest_summary(store.panel(store.latest())).collect()
    assert got == ex.latest_summary(deaths_panel(spark, base)).collect()


def test_empty_tables(spark, tmp_path):
    for name in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/base/{name}.parquet")
    store = StoredPanel(spark, str(tmp_path / "store"), str(tmp_path / "base"))
    store.build()
    assert store.panel().count() == 0 and store.latest().count() == 0
    store.refresh(at(0).date())
    assert store.panel().count() == 0


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        StoredPanel(spark, "x", "y", "other")
    with pytest.raises(ValueError):
        StoredPanel(spark, "x", "y", span="year")


def test_rows_read_counts_scans(spark):
    df = spark.read.parquet(f"{SF_SMALL}/nation.parquet").select("n_name")
    df.collect()
    assert rows_read(df) == [25]
