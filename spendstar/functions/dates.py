"""Calendar and fiscal column expressions (all built-in, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import as_date


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d) -> Column:
    return F.lit(as_date(d))


def time_key(d) -> Column:
    """YYYYMMDD as int, without a per-row string format."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fiscal_year(d) -> Column:
    """April-March fiscal year named by the calendar year in which it ends."""
    d = _c(d)
    return (F.year(d) + F.when(F.month(d) >= 4, 1).otherwise(0)).cast("int")


def fiscal_quarter(d) -> Column:
    """Apr-Jun = 1, Jul-Sep = 2, Oct-Dec = 3, Jan-Mar = 4."""
    return F.quarter(F.add_months(_c(d), 9)).cast("int")


def fiscal_month(d) -> Column:
    """April = 1 ... March = 12."""
    return F.month(F.add_months(_c(d), 9)).cast("int")


def week_of_year_monday(d) -> Column:
    """Week number with Monday as first day, days before the first Monday
    are week 0 (strftime ``%W``)."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def is_weekend(d) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")
