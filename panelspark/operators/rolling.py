"""Rolling statistics over row frames of each entity's series.

Frames count *rows*, not days: ``start=-6, end=0`` is the current row and the
six rows before it in date order, whatever gaps the series has or earlier
filters created. Pass ``by_days=True`` for a calendar frame instead (a range
frame over the day number).

All windows of one job that share (entity, date ordering) are evaluated by
one WindowExec after one shuffle on the entity. The panel key (entity, date)
is unique, so a window partition holds at most one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

_FUNCS = {
    "avg": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "stddev_pop": F.stddev_pop,
    "stddev_samp": F.stddev_samp,
}


def series_window(entity: str = "location", date: str = "date") -> Window:
    return Window.partitionBy(entity).orderBy(date)


def rolling(
    value: str,
    start: int,
    end: int,
    fn: str = "avg",
    entity: str = "location",
    date: str = "date",
    by_days: bool = False,
) -> Column:
    """``fn(value)`` over the frame [start, end] of the entity's series.

    ``fn`` is one of avg, sum, min, max, count, stddev_pop, stddev_samp.
    """
    if fn not in _FUNCS:
        raise ValueError(f"unknown rolling function {fn!r}")
    if by_days:
        day_no = F.unix_date(F.col(date))
        w = Window.partitionBy(entity).orderBy(day_no).rangeBetween(start, end)
    else:
        w = series_window(entity, date).rowsBetween(start, end)
    return _FUNCS[fn](value).over(w)


def shifted(value: str, offset: int, entity: str = "location", date: str = "date") -> Column:
    """``value`` from ``offset`` rows earlier (offset > 0, LAG) or later (offset < 0, LEAD)."""
    w = series_window(entity, date)
    return F.lag(value, offset).over(w) if offset >= 0 else F.lead(value, -offset).over(w)
