"""Reference-date arithmetic as Spark column expressions.

All windows are half-open ``[lo, hi)`` on the purchase timestamp.  The
upper bound of every observation window is ``dt_ref - 1 day`` (exclusive):
the feature definitions compare an ISO timestamp with an ISO date as text,
which keeps the first day of a window but drops the whole last day.
``include_last_day=True`` moves the upper bound to ``dt_ref`` instead.

Month shifts overflow, as the definitions' do: ``2018-03-31 - 1 month`` is day
31 of February, 2018-03-03 (:func:`shift_months_py`, :func:`shift_months_sql`;
``add_months`` would clamp to 2018-02-28).  From the first of a month both
agree; the month grain of :mod:`..operators.features` takes such dates alone,
:mod:`..operators.segments` takes any.  The six trailing windows always nest.
"""

from __future__ import annotations

import calendar
import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trailing windows of the feature definitions, in months.
OBSERVATION_MONTHS = 12
TRAILING_WINDOWS = (1, 2, 3, 4, 5, 6)
ACTIVATION_MONTHS = 6
# Bucket value for rows older than the widest trailing window.
OUTSIDE_TRAILING = len(TRAILING_WINDOWS) + 1


def parse_date(value: str | _dt.date) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def ref_dates(dates: Iterable[str | _dt.date]) -> list[_dt.date]:
    """Parse, sort and de-duplicate reference dates of any day."""
    out = sorted({parse_date(d) for d in dates})
    if not out:
        raise ValueError("at least one reference date is required")
    return out


def validate_ref_dates(dates: Iterable[str | _dt.date]) -> list[_dt.date]:
    """:func:`ref_dates`, all of them the first of a month."""
    out = ref_dates(dates)
    bad = [d.isoformat() for d in out if d.day != 1]
    if bad:
        raise ValueError(f"reference dates must be the first day of a month: {bad}")
    return out


def add_months_py(d: _dt.date, months: int) -> _dt.date:
    """Calendar month shift of a first-of-month date (driver-side parameter math)."""
    idx = d.year * 12 + (d.month - 1) + months
    return _dt.date(idx // 12, idx % 12 + 1, d.day)


def shift_months_py(d: _dt.date, months: int) -> _dt.date:
    """Calendar month shift; days that the month doesn't have run over into the next one."""
    return add_months_py(d.replace(day=1), months) + _dt.timedelta(days=d.day - 1)


def shift_months_sql(d: str, months: int) -> str:
    """:func:`shift_months_py` of a date column, as SQL text."""
    return f"date_add(add_months(trunc({d}, 'MM'), {months}), dayofmonth({d}) - 1)"


def monthly_range(first: str | _dt.date, last: str | _dt.date) -> list[_dt.date]:
    """All dates from ``first`` to ``last`` inclusive, each a month after the one before.

    A step goes to the month's last day where it lacks the day, and the next
    one starts there: 01-31, 02-28, 03-28.  From a first of month all are.
    """
    lo, hi = parse_date(first), parse_date(last)
    if hi < lo:
        raise ValueError(f"last reference date {hi} is before the first {lo}")
    out, d = [], lo
    while d <= hi:
        out.append(d)
        after = add_months_py(d.replace(day=1), 1)
        d = after.replace(day=min(d.day, calendar.monthrange(after.year, after.month)[1]))
    return out


def window_end(ref: Column, include_last_day: bool = False) -> Column:
    """Exclusive upper bound shared by every observation window."""
    return ref if include_last_day else F.date_sub(ref, 1)


def in_observation(ts: Column, ref: Column, include_last_day: bool = False) -> Column:
    """Purchase within the 12 months before ``ref`` (the ``_ate_hoje`` scope)."""
    return (ts >= F.add_months(ref, -OBSERVATION_MONTHS)) & (ts < window_end(ref, include_last_day))


def mask_after(value: Column, ref: Column) -> Column:
    """As-of view of an event date: NULL when it happened on/after ``ref``."""
    return F.when(value < ref, F.to_date(value))


def month_number(d: _dt.date) -> int:
    return d.year * 12 + d.month


def month_number_sql(d: str) -> str:
    return f"(year({d}) * 12 + month({d}))"


def month_start_sql(number: str) -> str:
    """The first day of a month given by its number (year * 12 + month)."""
    return f"make_date(CAST(({number} - 1) DIV 12 AS INT), CAST(({number} - 1) % 12 + 1 AS INT), 1)"


def observed_months_sql(dates: Sequence[_dt.date], pm: str, ld: str, include_last_day: bool = False,
                        also: str = "true") -> list[str]:
    """The reference months that observe a purchase of month ``pm``: at most 12 candidates, whatever the number of dates.

    ``ld``: whether the purchase was on the last day of its month, which the next month doesn't observe.
    """
    asked = ", ".join(str(month_number(d)) for d in dates)
    out = []
    for j in range(1, OBSERVATION_MONTHS + 1):
        rule = f"{pm} + {j} IN ({asked}) AND {also}"
        if j == 1 and not include_last_day:
            rule += f" AND NOT ({ld})"
        out.append(f"CASE WHEN {rule} THEN {pm} + {j} END")
    return out


def union_observation_bounds(dates: Sequence[_dt.date], include_last_day: bool = False):
    """Driver-side literal bounds covering every date's window (for scan pushdown)."""
    lo = add_months_py(min(dates), -OBSERVATION_MONTHS)
    hi = max(dates) if include_last_day else max(dates) - _dt.timedelta(days=1)
    return lo, hi


def union_label_bounds(dates: Sequence[_dt.date], include_last_day: bool = False):
    lo = min(dates)
    hi = add_months_py(max(dates), 1)
    return lo, (hi if include_last_day else hi - _dt.timedelta(days=1))
