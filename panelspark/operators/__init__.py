"""Reusable DataFrame operators (built-in Spark expressions only)."""

from panelspark.operators.bitmaps import distinct_ids, id_bitmaps, merged, trailing_days
from panelspark.operators.fixpoint import follow
from panelspark.operators.islands import runs
from panelspark.operators.joins import asof_join, checked_panel_join, duplicate_keys, panel_join
from panelspark.operators.lags import best_lag, lag_correlations
from panelspark.operators.latest import aggregate_latest, latest_global, latest_per_entity, rows_at_entity_latest
from panelspark.operators.milestones import crossings, pivot_dates
from panelspark.operators.profile import two_level_profile
from panelspark.operators.profiling import completeness, overview
from panelspark.operators.ranking import best_rows, global_row_number, positions_of, top_k
from panelspark.operators.rolling import rolling, series_window, shifted
from panelspark.operators.seasonal import centred_mean, seasonal_indices

__all__ = [
    "aggregate_latest",
    "asof_join",
    "best_lag",
    "best_rows",
    "centred_mean",
    "checked_panel_join",
    "completeness",
    "crossings",
    "distinct_ids",
    "duplicate_keys",
    "follow",
    "global_row_number",
    "id_bitmaps",
    "lag_correlations",
    "latest_global",
    "latest_per_entity",
    "merged",
    "overview",
    "panel_join",
    "pivot_dates",
    "positions_of",
    "rolling",
    "rows_at_entity_latest",
    "runs",
    "seasonal_indices",
    "series_window",
    "shifted",
    "top_k",
    "trailing_days",
    "two_level_profile",
]
