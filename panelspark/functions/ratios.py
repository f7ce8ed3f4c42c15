"""NULL-safe percentages and growth rates.

The source analyses divide with ``a * 100.0 / b`` and expect NULL when ``b`` is
zero (MySQL semantics). Spark in ANSI mode raises on division by zero, so
every division here goes through ``try_divide``. The literal is a double so
``bigint * 100.0`` stays a double instead of becoming a wide decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_ratio(num, den, places: int | None = None) -> Column:
    """``num * 100.0 / den``; NULL when ``den`` is 0 or NULL; optionally rounded.

    Rounded to ``places`` as ``round(num * 10**(places + 2) / den) / 10**places``:
    for whole-number inputs this is the exact decimal result rounded half away
    from zero. A percentage such as 24450 * 100 / 1000000 = 2.445 sits exactly
    on a tie; rounding the binary quotient instead would go to whichever side
    of 2.445 the nearest double happens to lie.
    """
    if places is None:
        return F.try_divide(_col(num) * F.lit(100.0), _col(den))
    scaled = F.try_divide(_col(num) * F.lit(float(10 ** (places + 2))), _col(den))
    return F.round(scaled, 0) / F.lit(10 ** places)


def growth_pct(current, previous, places: int | None = 2) -> Column:
    """Percent change from ``previous`` to ``current``; NULL unless ``previous > 0``."""
    prev = _col(previous)
    change = pct_ratio(_col(current) - prev, prev, places)
    return F.when(prev > 0, change)


def mean_of_rounded(col, places: int) -> Column:
    """``ROUND(AVG(col), places)`` for a column that already holds values with at
    most ``places`` decimals (counts, or an earlier ROUND to ``places``).

    Averages of such values hit exact ties (34.4 and 34.5 average to 34.45) far
    more often than chance, and the binary double nearest a tie lies on either
    side of it depending on the order of the additions. The mean is therefore
    taken in integer units of ``10**-places``: the sum is exact, a real tie is
    exactly representable, and it is rounded half away from zero, which is the
    decimal result of the original ``ROUND(AVG(..))``.
    """
    unit = 10 ** places
    return F.round(F.avg(F.round(_col(col) * F.lit(unit), 0)), 0) / F.lit(unit)


def mean_of_decimals(col, places: int, digits: int = 6) -> Column:
    """``ROUND(AVG(col), places)`` for a column with at most ``digits`` decimals.

    Taken in integer units of ``10**-digits``, for the reason given in
    ``mean_of_rounded``; the values themselves are not rounded to ``places``.
    """
    mean = F.avg(F.round(_col(col) * F.lit(10 ** digits), 0)) / F.lit(10 ** (digits - places))
    return F.round(mean, 0) / F.lit(10 ** places)


def correlation(x, y) -> Column:
    """Pearson correlation of the pairs without a NULL; NULL if a side has no variance.

    An aggregate. ``corr`` itself divides by zero there, which ANSI mode raises."""
    a, b = _col(x).cast("double"), _col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
