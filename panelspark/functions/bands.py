"""Banding: map a numeric column to a label from a list of cut-offs.

Three conventions occur in the analyses:

* ``"lt"`` - ascending cut-offs, first arm with ``x < cut`` wins, ELSE the last label;
* ``"gt"`` - descending cut-offs, first arm with ``x > cut`` wins, ELSE the last label;
* ``"ge"`` - descending cut-offs, first arm with ``x >= cut`` wins, ELSE the last label.

A NULL input matches no arm and so gets the ELSE label, as in SQL CASE.
Each band also has a report order (``order``) used to sort job output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Banding:
    cuts: tuple
    labels: tuple  # one per cut, then the ELSE label
    mode: str  # "lt" | "gt" | "ge"
    order: tuple  # labels in report order

    def __post_init__(self):
        if len(self.labels) != len(self.cuts) + 1:
            raise ValueError("need one label per cut-off plus the ELSE label")
        if self.mode not in ("lt", "gt", "ge"):
            raise ValueError(f"unknown banding mode {self.mode!r}")
        if sorted(self.order) != sorted(self.labels):
            raise ValueError("order must be a permutation of labels")

    def label(self, value) -> Column:
        v = _col(value)
        expr = None
        for cut, lab in zip(self.cuts, self.labels):
            cond = {"lt": v < cut, "gt": v > cut, "ge": v >= cut}[self.mode]
            expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
        return expr.otherwise(F.lit(self.labels[-1]))

    def ordinal(self, label_col) -> Column:
        """1-based position of a label in report order (NULL for unknown labels)."""
        lab = _col(label_col)
        expr = None
        for i, name in enumerate(self.order, start=1):
            expr = F.when(lab == name, F.lit(i)) if expr is None else expr.when(lab == name, F.lit(i))
        return expr


# ---------------------------------------------------------------------------
# Cut-offs and output labels of the reference analyses. They are
# part of the results and must stay exactly as written.
# ---------------------------------------------------------------------------

GROWTH_PHASES = Banding(
    cuts=(100, 1000, 10000, 100000, 1000000),
    labels=(
        "Initial Phase (<100 cases)",
        "Early Growth (100-1K cases)",
        "Rapid Growth (1K-10K cases)",
        "Major Outbreak (10K-100K cases)",
        "Large Scale (100K-1M cases)",
        "Massive Outbreak (>1M cases)",
    ),
    mode="lt",
    order=(
        "Initial Phase (<100 cases)",
        "Early Growth (100-1K cases)",
        "Rapid Growth (1K-10K cases)",
        "Major Outbreak (10K-100K cases)",
        "Large Scale (100K-1M cases)",
        "Massive Outbreak (>1M cases)",
    ),
)

VACCINATION_PHASES = Banding(
    cuts=(10, 30, 50, 70),
    labels=(
        "Pre-Vaccination (<10%)",
        "Early Vaccination (10-30%)",
        "Mid Vaccination (30-50%)",
        "High Vaccination (50-70%)",
        "Full Vaccination (>70%)",
    ),
    mode="lt",
    order=(
        "Pre-Vaccination (<10%)",
        "Early Vaccination (10-30%)",
        "Mid Vaccination (30-50%)",
        "High Vaccination (50-70%)",
        "Full Vaccination (>70%)",
    ),
)

VACCINATION_LEVELS = Banding(
    cuts=(50, 30, 10),
    labels=(
        "High Vaccination (>50%)",
        "Medium Vaccination (30-50%)",
        "Low Vaccination (10-30%)",
        "Minimal Vaccination (<10%)",
    ),
    mode="gt",
    order=(
        "Minimal Vaccination (<10%)",
        "Low Vaccination (10-30%)",
        "Medium Vaccination (30-50%)",
        "High Vaccination (>50%)",
    ),
)

BOOSTER_LEVELS = Banding(
    cuts=(30, 15, 5),
    labels=(
        "High Booster Coverage (>30%)",
        "Medium Booster Coverage (15-30%)",
        "Low Booster Coverage (5-15%)",
        "Minimal Booster Coverage (<5%)",
    ),
    mode="gt",
    order=(
        "Minimal Booster Coverage (<5%)",
        "Low Booster Coverage (5-15%)",
        "Medium Booster Coverage (15-30%)",
        "High Booster Coverage (>30%)",
    ),
)

DEVELOPMENT_LEVELS = Banding(
    cuts=(0.8, 0.7, 0.55),
    labels=(
        "Very High Development",
        "High Development",
        "Medium Development",
        "Low Development",
    ),
    mode="ge",
    order=(
        "Very High Development",
        "High Development",
        "Medium Development",
        "Low Development",
    ),
)

# Coverage milestones: threshold and label, in the order the arms are tested.
MILESTONES = (
    (10, "10% Milestone"),
    (30, "30% Milestone"),
    (50, "50% Milestone"),
    (70, "70% Milestone"),
)

# Other fixed output labels.
OUTLIER_HIGH = "High Outlier"
OUTLIER_LOW = "Low Outlier"
OUTLIER_NORMAL = "Normal"
POPULATION_VARIES = "Population varies - potential data issue"
POPULATION_CONSISTENT = "Population consistent"
CONTINENT_VARIES = "Continent varies - potential data issue"
CONTINENT_CONSISTENT = "Continent consistent"
PEAK_CASES = "Peak Cases"
PEAK_DEATHS = "Peak Deaths"
NOT_PEAK = "Not Peak"
GLOBAL_SUMMARY = "Global Summary"
DATASET_NAMES = ("CovidDeaths", "CovidVaccinations")
