"""Run parameters.

Every operator that the source system evaluated against "today" takes an
explicit ``as_of`` date instead, so results do not change with the wall clock.
"""

from __future__ import annotations

import datetime as _dt

# Fixed values of the test fixtures (FIXTURES.md).
AS_OF = _dt.date(2023, 11, 5)
FISCAL_YEAR = 2024

# Calendar range of dim_time (fixed values of the source system).
CALENDAR_START = _dt.date(2009, 1, 1)
CALENDAR_END = _dt.date(2030, 12, 31)

# Fiscal year runs April to March and is named after the calendar year in
# which it ends (April 2023 - March 2024 is fiscal 2024).
FISCAL_START_MONTH = 4


def fiscal_year_bounds(fy: int) -> tuple[_dt.date, _dt.date]:
    """First and last day of a fiscal year."""
    return _dt.date(fy - 1, FISCAL_START_MONTH, 1), _dt.date(fy, FISCAL_START_MONTH, 1) - _dt.timedelta(days=1)


def time_key_of(d: _dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def fiscal_year_time_keys(fy: int) -> tuple[int, int]:
    """Inclusive ``time_key`` range (YYYYMMDD) of a fiscal year.

    Used to put a range predicate directly on the fact scan so Parquet
    row-group statistics (and partition pruning, when facts are partitioned
    by fiscal year) skip data before the calendar join runs.
    """
    a, b = fiscal_year_bounds(fy)
    return time_key_of(a), time_key_of(b)


def as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))
