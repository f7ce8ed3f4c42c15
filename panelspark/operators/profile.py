"""Two-level profiles: statistics per (entity, band), then per band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_level_profile(
    df: DataFrame,
    band: str,
    stage1: Sequence[Column],
    stage2: Sequence[Column],
    min_rows: int = 0,
    entity_keys: Sequence[str] = ("location",),
    count_name: str = "_rows",
) -> DataFrame:
    """Aggregate per (entity_keys, band), keep cells with more than ``min_rows``
    rows, then aggregate the surviving cells per band.

    ``stage1`` are aggregate expressions over the input rows; ``stage2`` are
    aggregate expressions over the stage-1 columns (plus ``count_name``, the
    stage-1 row count). Both stages are hash aggregates with map-side partial
    aggregation, so a hot entity or band adds no skew to the shuffle; the
    stage-2 input holds at most (entities x bands) rows.
    """
    cells = (
        df.groupBy(*entity_keys, band)
        .agg(F.count(F.lit(1)).alias(count_name), *stage1)
        .where(F.col(count_name) > min_rows)
    )
    return cells.groupBy(band).agg(*stage2)
