"""Recursion over a table of pointers, as a fixpoint of joins.

A recursive query that follows one pointer per row (a row's successor is one other row)
takes as many steps as its longest chain. Here every round doubles the
length of the pointers, so about the logarithm of that many rounds find every row that
a start leads to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import ensure_checkpoint_dir


def follow(pointers: DataFrame, by: Sequence[str], node: str, successor: str, start: str) -> DataFrame:
    """(by, node) of the rows that are a start, or are reached from one by following ``successor``.

    ``pointers`` has a row per (``by``, ``node``); ``successor`` is a node of the same ``by`` or
    NULL, ``start`` a boolean. Pointers to rows that do not exist end their chain, and
    chains may meet or close to a ring.

    After r rounds a row points 2 ** r steps on, and all rows less than that many steps
    behind a start are reached. Each round is two equi-joins on (by, node), made durable by a
    checkpoint in the shared folder; it ends when nothing new is reached and no longer
    pointer is left, so it runs jobs when it is built.
    """
    ensure_checkpoint_dir(pointers.sparkSession)
    keys = [*by, node]
    state = pointers.select(
        *keys, F.col(successor).alias("_to"), F.coalesce(F.col(start), F.lit(False)).alias("_reached")
    ).checkpoint(eager=True)
    reached = -1
    while True:
        progress = state.agg(F.count_if("_reached").alias("reached"), F.count("_to").alias("open")).first()
        if not progress["open"] or progress["reached"] == reached:
            return state.where("_reached").select(*keys)
        reached = progress["reached"]
        ahead = state.select(*by, F.col(node).alias("_to"), F.col("_to").alias("_further"), F.lit(True).alias("_exists"))
        hit = (
            state.where(F.col("_reached") & F.col("_to").isNotNull())
            .select(*by, F.col("_to").alias(node), F.lit(True).alias("_hit")).distinct()
        )
        state = (
            state.join(ahead, [*by, "_to"], "left").join(hit, keys, "left")
            .select(
                *keys, F.when(F.col("_exists"), F.col("_further")).alias("_to"),
                (F.col("_reached") | F.coalesce("_hit", F.lit(False))).alias("_reached"),
            )
            .checkpoint(eager=True)
        )
