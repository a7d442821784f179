"""Aggregate helpers with exact, order-independent results.

Money and REAL scores are summed as decimals, so the result does not
depend on how rows are split across tasks (double sums do). Ratios use
``try_divide``: a zero or NULL denominator gives NULL instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c, scale: int = 2) -> Column:
    return _c(c).cast(f"decimal(18,{scale})")


def real(c) -> Column:
    """A REAL value as a decimal with 12 decimal places: summed exactly, and
    wide enough to keep the value."""
    return _c(c).cast("decimal(38,12)")


def dsum(c, scale: int = 2) -> Column:
    """Exact sum of a money or score column, reported as double."""
    return F.sum(dec(c, scale)).cast("double")


def davg(c) -> Column:
    """Mean over non-null values computed from an exact sum."""
    return F.try_divide(F.sum(real(c)).cast("double"), F.count(_c(c)))


def ratio(num, den) -> Column:
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den) -> Column:
    """100 * num / den, NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * F.lit(100.0)
