"""Physical-plan checks: the plans the jobs are meant to get."""

import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from panelspark import catalog
from panelspark.operators.joins import panel_join
from panelspark.plans import exploration as ex
from panelspark.plans import vaccination as vx
from panelspark.sources.panels import deaths_panel, vax_panel


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_entity_uses_window_group_limit(spark):
    text = plan_text(vx.latest_coverage(vax_panel(spark, SF_SMALL)))
    assert "WindowGroupLimit" in text


def test_completeness_scans_each_table_once(spark):
    df = ex.column_completeness(deaths_panel(spark, SF_SMALL), vax_panel(spark, SF_SMALL))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # one aggregate per panel, unpivoted (Expand), not one per column
    assert text.count("Aggregate [count(1)") == 2
    assert "Expand" in text


def test_scans_are_pruned_and_filtered(spark):
    text = plan_text(ex.group_distribution(deaths_panel(spark, SF_SMALL)))
    # orders and customer are read with only the needed columns
    schemas = {frozenset(f.split(":")[0] for f in m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", text)}
    assert frozenset({"o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate"}) in schemas
    assert frozenset({"c_custkey", "c_nationkey"}) in schemas
    for unused in ("o_orderkey", "o_orderpriority", "c_name", "c_acctbal", "c_mktsegment"):
        assert unused not in text


# A numbering of all rows has to fix the partitions before it counts them.
# Stored tables and files are written, and recursion is checkpointed, before they are read.
EAGER = {"global_row_number", "csv_quarantine", "spaced_peaks", "spaced_peaks_by_supplier", "stored_outcomes",
         "stored_coverage", "stored_latest_by_supplier", "stored_latest_summary", "stored_global_trend"}
QUERIES = catalog.all_queries()


@pytest.mark.parametrize("query", QUERIES, ids=[q.name for q in QUERIES])
def test_no_python_udf_or_cross_join_and_no_job_at_build(spark, query):
    spark.sparkContext.setJobGroup(query.name, "build")
    text = plan_text(query.build(spark, SF_SMALL))
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(i) for i in tracker.getJobIdsForGroup(query.name)]
    stages = [tracker.getStageInfo(i) for job in jobs if job for i in job.stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading the schema of a Parquet folder is a job of Spark's own
    assert query.name in EAGER or all(s.name.startswith("parquet at") for s in stages if s)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in text
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("build", [deaths_panel, vax_panel])
@pytest.mark.parametrize("grain", ["nation", "supplier"])
def test_panel_fills_days_after_its_shuffles(spark, build, grain):
    panel = build(spark, SF_SMALL, grain).where("continent is not null")
    text = plan_text(panel)
    spine = text[: text.index("Subqueries")] if "Subqueries" in text else text
    filled = [m.start() for m in re.finditer(r"Generate explode\(sequence", spine)]
    assert len(filled) == 1
    # nothing is shuffled above the generated days (a plan is printed from the top)
    assert "Exchange" not in spine[: filled[0]]
    assert spine.count("Exchange hashpartitioning") <= 4  # the two full ones, and small sides of joins


def test_inequality_keeps_only_last_rows_before_the_shuffle(spark):
    assert plan_text(vx.inequality(vax_panel(spark, SF_SMALL))).count("WindowGroupLimit") >= 2


def test_panel_join_leaves_the_plan_to_spark_unless_asked(spark):
    v, d = vax_panel(spark, SF_SMALL), deaths_panel(spark, SF_SMALL)
    free = panel_join(v, d.drop("continent", "population"))._jdf.queryExecution().optimizedPlan().toString()
    asked = panel_join(v, d.drop("continent", "population"), co_partition_on="location")
    assert "RepartitionByExpression" not in free
    assert asked._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2


def test_hot_entity_is_split_in_a_panel_join(spark):
    """One entity with half of the rows: AQE splits its partition."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "8k", "4k", "false"), strict=True):
            spark.conf.set(k, v)
        location = F.when(F.col("id") < 20000, F.lit("hot")).otherwise(F.concat(F.lit("e"), F.col("id") % 200))
        left = spark.range(0, 40000, 1, 8).select(
            location.alias("location"), F.lit(1).alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("x")
        )
        right = spark.range(200).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("e"), "id")).alias("location"), F.lit(1).alias("date")
        )
        joined = panel_join(left, right, keys=("location", "date"))
        rows = joined.collect()
        assert len(rows) > 20000
        assert "skew=true" in plan_text(joined).split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed_nodes(df):
    """The physical nodes that ran, those of subqueries included."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, seen = [plan], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        seen.append((kind, node))
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        for many in (node.children(), node.subqueries()):
            todo += [many.apply(i) for i in range(many.size())]
    return seen


def rows_read(df):
    """Rows that the scans of an executed DataFrame have put out, by scan."""
    return sorted(
        node.metrics().apply("numOutputRows").value() for kind, node in executed_nodes(df) if kind == "FileSourceScanExec"
    )


def test_rankings_read_the_panel_once(spark):
    from panelspark.plans import global_analysis as ga

    df = ga.entity_rankings(deaths_panel(spark, SF_SMALL))
    derivations = df._jdf.queryExecution().optimizedPlan().toString().count("max_by(")
    assert derivations <= 2  # the panel, and the same once more in the choice of the rows
    assert len(df.collect()) > 0
    # orders come into the plan for the calendar and for the facts, and only these are read
    read = rows_read(df)
    assert sum(read) <= 2 * 1500 + 6000 + 2 * 150 + 200


def test_calendar_is_one_subquery(spark):
    df = deaths_panel(spark, SF_SMALL).join(vax_panel(spark, SF_SMALL).select("location", "date"), ["location", "date"])
    df.collect()
    facts = [n for n in rows_read(df) if n >= 1500]
    assert facts.count(6000) <= 2 and facts.count(1500) <= 2  # the facts themselves, and one calendar
