"""Column roles of a panel table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PanelSpec:
    """Names the three structural columns of a panel.

    ``group``  - the grouping attribute; rows where it is NULL are aggregate
                 rows (for example a region total) and every job drops them.
    ``entity`` - the series key; together with ``date`` it is the panel key.
    ``date``   - the day of the measurement.
    """

    group: str = "continent"
    entity: str = "location"
    date: str = "date"


DEFAULT = PanelSpec()
