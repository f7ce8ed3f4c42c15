"""Global rankings and top-k without funnelling the table through one task.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY makes Spark move
every row into a single partition. That is fine for inputs bounded by the
calendar or by the number of groups, but not for one row per entity when
entities are many. ``global_row_number`` computes the same numbers with a
range-partitioned sort:

1. range-partition the rows on the ordering (Spark samples the key to pick
   boundaries, so partitions are balanced), record the partition id, and
   checkpoint that to the shared checkpoint folder: the ids are fixed from
   then on, so a lost executor or a second read cannot renumber anything;
2. number the rows of each partition with a window over it;
3. count rows per partition (one row per partition), turn the counts into
   offsets with a running sum, and broadcast them back (size bounded by the
   number of partitions).

The ordering must be total (append unique tie-break columns), otherwise the
numbering of tied rows is arbitrary, exactly as with SQL ROW_NUMBER.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import ensure_checkpoint_dir


def global_row_number(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "row_number",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` over the whole DataFrame."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    placed = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    numbered = placed.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return numbered.join(F.broadcast(offsets), "_part").select(
        *columns, (F.col("_offset") + F.col("_local")).alias(name)
    )


def best_rows(df: DataFrame, k: int, key: str, metrics: Sequence[str]) -> DataFrame:
    """The rows that are among the first ``k`` by any of ``metrics``: descending, NULL last, ties by ``key``.

    ``df`` is used once: every row goes into one numbering per metric, of which
    each task keeps its own first ``k`` (WindowGroupLimit). The metrics need a common type."""
    orders = F.array(*[F.struct(F.lit(i).alias("order"), F.col(m).alias("value")) for i, m in enumerate(metrics)])
    columns = [F.col(c) for c in df.columns]
    place = Window.partitionBy("o.order").orderBy(F.col("o.value").desc_nulls_last(), F.col(key))
    return (
        df.select(*columns, F.explode(orders).alias("o"))
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= k)
        .select(*columns)
        .distinct()
    )


def positions_of(
    selected: DataFrame, df: DataFrame, key: str, rankings: Sequence[tuple[str, str]]
) -> DataFrame:
    """For the few rows of ``selected``, their position in each ranking of all rows of ``df``.

    A ranking (name, metric) is descending, NULL last, ties by ``key``; the
    position is one more than the number of rows ahead. The selected rows, whose number must be
    a small constant such as a top k, become one array.

    Their metric values cut each ranking into ranges. Every row of ``df`` finds its
    range, and a histogram of the ranges, summed on the map side, is all that
    is shuffled: (number of rankings) * (number of selected rows + 1) counts. The position of a
    selected row is one more than the sum of the ranges ahead of it. ``df`` is read
    once, in parallel, and no task sorts it: the array goes along as a key of the first ranking's
    ranges, since an aggregate of it would have every row sorted with a copy of its own.
    """
    metrics = [m for _, m in rankings]
    chosen = selected.agg(F.collect_list(F.struct(*selected.columns)).alias("s")).select("s").scalar()

    def ahead(a: Column, b: Column, metric: str) -> Column:
        x, y = a[metric], b[metric]
        tie = x.eqNullSafe(y) & (a[key] < b[key])
        return F.coalesce(x > y, x.isNotNull() & y.isNull()) | tie

    def range_of(metric: str) -> Column:
        """How many selected rows a row is not ahead of."""
        return F.size(F.filter("chosen", lambda c: ~ahead(F.col("me"), c, metric)))

    ranges = F.array(*[
        F.struct(F.lit(i).alias("ranking"), range_of(m).alias("range")) for i, m in enumerate(metrics)
    ])
    counts = (
        df.select(F.struct(key, *dict.fromkeys(metrics)).alias("me"), chosen.alias("chosen"))
        .select("chosen", F.explode(ranges).alias("at"))
        .groupBy("at.ranking", "at.range", F.when(F.col("at.ranking") == 0, F.col("chosen")).alias("chosen"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.collect_list(F.struct("ranking", "range", "rows")).alias("counts"),
            F.first("chosen", ignorenulls=True).alias("chosen"),
        )
    )

    def position(i: int, metric: str) -> Column:
        own = F.size(F.filter("chosen", lambda c: ahead(c, F.col("row"), metric)))
        before = F.filter("counts", lambda h: (h["ranking"] == i) & (h["range"] <= own))
        return F.aggregate(before, F.lit(1).cast("long"), lambda n, h: n + h["rows"])

    rows = counts.select("*", F.explode("chosen").alias("row"))
    return rows.select("row.*", *[position(i, m).alias(name) for i, (name, m) in enumerate(rankings)])


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows in ``order``: each task keeps its own k best rows and
    only those reach the final merge (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)
