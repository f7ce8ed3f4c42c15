"""Column-level helpers (pure Spark expressions, no UDFs)."""

from panelspark.functions.bands import (
    BOOSTER_LEVELS,
    DEVELOPMENT_LEVELS,
    GROWTH_PHASES,
    MILESTONES,
    VACCINATION_LEVELS,
    VACCINATION_PHASES,
    Banding,
)
from panelspark.functions.ratios import growth_pct, mean_of_rounded, pct_ratio

__all__ = [
    "BOOSTER_LEVELS",
    "DEVELOPMENT_LEVELS",
    "GROWTH_PHASES",
    "MILESTONES",
    "VACCINATION_LEVELS",
    "VACCINATION_PHASES",
    "Banding",
    "growth_pct",
    "mean_of_rounded",
    "pct_ratio",
]
