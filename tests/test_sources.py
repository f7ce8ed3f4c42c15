"""Sources: CSV panel ingest and the driver entry point."""

import os
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.sources import DEATHS_SCHEMA, deaths_panel, read_panel_csv, vax_panel
from panelspark.sources.panels import DEATHS_COLUMNS


def test_csv_round_trip_with_extra_and_reordered_columns(spark):
    panel = deaths_panel(spark, SF_SMALL).where(F.col("continent").isNotNull())
    # a portal export: more columns, another order, counts written as "123.0"
    export = panel.select(
        F.lit("x").alias("iso_code"),
        *reversed([F.col(c).cast("double").alias(c) if c in ("new_cases", "total_cases") else F.col(c)
                   for c in DEATHS_COLUMNS]),
    )
    path = os.path.join(tempfile.mkdtemp(prefix="panelspark-csv-"), "deaths")
    export.write.option("header", True).csv(path)
    back = read_panel_csv(spark, path, DEATHS_SCHEMA)
    assert back.columns == list(DEATHS_COLUMNS)
    assert back.schema == DEATHS_SCHEMA or [f.dataType for f in back.schema] == [f.dataType for f in DEATHS_SCHEMA]
    assert back.count() == panel.count()
    diff = back.select(*DEATHS_COLUMNS[:8]).exceptAll(panel.select(*DEATHS_COLUMNS[:8]))
    assert diff.count() == 0


def test_entry_returns_rows(spark):
    import __spark_entry__ as entry_module

    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "global_new_cases" in df.columns
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("root", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_no_fact_is_lost(spark, root):
    lines = spark.read.parquet(f"{root}/lineitem.parquet").agg(F.sum(F.floor("l_quantity"))).first()[0]
    orders = spark.read.parquet(f"{root}/orders.parquet").agg(F.sum(F.floor(F.col("o_totalprice") / 100))).first()[0]
    for grain in ("nation", "supplier"):
        assert vax_panel(spark, root, grain).agg(F.sum("new_vaccinations")).first()[0] == lines
    assert deaths_panel(spark, root).where("continent is not null").agg(F.sum("new_cases")).first()[0] == orders


def test_appended_rows_are_seen(spark, tmp_path):
    for name in ("nation", "region", "customer", "supplier", "orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    total = lambda: deaths_panel(spark, str(tmp_path)).where("continent is not null").agg(F.sum("new_cases")).first()[0]
    before = total()
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert total() == 2 * before


def test_panels_are_dense_and_carry_totals_forward(spark):
    panel = deaths_panel(spark, SF_SMALL, "supplier").where("continent is not null")
    per = panel.groupBy("location").agg(F.count("*").alias("n"), F.count_distinct("date").alias("d"), F.min("date"), F.max("date"))
    rows = per.collect()
    assert len({tuple(r)[1:] for r in rows}) == 1 and all(r.n == r.d for r in rows)
    w = Window.partitionBy("location").orderBy("date")
    steps = panel.withColumn("before", F.coalesce(F.lag("total_cases").over(w), F.lit(0)))
    kept = F.coalesce("total_cases", F.lit(0)) - F.col("before") == F.coalesce("new_cases", F.lit(0))
    assert steps.where(~kept).count() == 0


def test_checkpoint_folder_is_never_made_up():
    from panelspark.session import ensure_checkpoint_dir

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
