"""Calendar arithmetic for the split plan, and the date-cell expression."""

from __future__ import annotations

import calendar
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = {"y": 12, "m": 1}
_DAYS = {"w": 7, "d": 1}
_PART = re.compile(r"(\d+)\s*([A-Za-z]+)")


@dataclass(frozen=True)
class Interval:
    """Calendar months plus days; months are applied first and clamp at month end."""

    months: int = 0
    days: int = 0

    def __mul__(self, times: int) -> Interval:
        return Interval(self.months * times, self.days * times)

    def __neg__(self) -> Interval:
        return self * -1


def parse_date(text: str | date) -> date:
    if isinstance(text, datetime):
        return text.date()
    if isinstance(text, date):
        return text
    return datetime.strptime(text, "%Y-%m-%d").date()


def parse_interval(text: str) -> Interval:
    """Read `'2 years'`, `'2y'`, `'6 months'`, `'14 days'` or a sum of such parts."""
    parts = _PART.findall(text)
    if not parts or _PART.sub("", text).strip():
        raise ValueError(f"not an interval: {text!r}")
    months = days = 0
    for amount, unit in parts:
        letter = unit[0].lower()
        if letter in _MONTHS and not unit.lower().startswith("mi"):
            months += int(amount) * _MONTHS[letter]
        elif letter in _DAYS:
            days += int(amount) * _DAYS[letter]
        else:
            raise ValueError(f"unsupported interval unit {unit!r} in {text!r}")
    return Interval(months, days)


def shift(day: date, by: Interval) -> date:
    months = day.year * 12 + day.month - 1 + by.months
    year, month = divmod(months, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last)) + timedelta(days=by.days)


def next_day(day: date) -> date:
    return day + timedelta(days=1)


def date_cell(column: Column, starts: Sequence[date]) -> Column:
    """The latest of the sorted `starts` on or before `column` (the year 1000 below all).

    Any predicate that only compares the column with these starts has one value on
    the whole cell, so rows may be aggregated per cell before the predicate is
    known.  Written as a balanced CASE, so a row costs log2(n) comparisons.
    """
    bounds = [date(1000, 1, 1), *starts]

    def choose(low: int, high: int) -> Column:
        if high - low == 1:
            return F.lit(bounds[low])
        mid = (low + high) // 2
        return F.when(column < F.lit(bounds[mid]), choose(low, mid)).otherwise(choose(mid, high))

    return choose(0, len(bounds))
