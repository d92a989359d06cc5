"""The thirteen runtime date parameters as half-open ranges around an injected moment."""

from __future__ import annotations

from datetime import datetime, timedelta

from ..errors import SpecError

#: The names of runtime date parameters.
RUNTIME_DATES = ("now", "today", "thisWeek", "thisMonth", "thisYear", "yesterday", "previousWeek", "previousMonth", "previousYear", "tomorrow", "nextWeek", "nextMonth", "nextYear")


def _month(day: datetime, by: int) -> datetime:
    at = day.year * 12 + day.month - 1 + by
    return day.replace(year=at // 12, month=at % 12 + 1, day=1)


def date_range(kind: str, as_of: datetime, week_starts: int = 0) -> tuple[datetime, datetime]:
    """[start, end) of a runtime date; week_starts is the weekday, 0 for Monday. now is the empty range at as_of."""
    if kind not in RUNTIME_DATES:
        raise SpecError(f"unknown runtime date {kind}")
    if kind == "now":
        return as_of, as_of
    day = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    if kind in ("yesterday", "today", "tomorrow"):
        start = day + timedelta(days=("yesterday", "today", "tomorrow").index(kind) - 1)
        return start, start + timedelta(days=1)
    by = {"previous": -1, "this": 0, "next": 1}[kind.removesuffix("Week").removesuffix("Month").removesuffix("Year")]
    if kind.endswith("Week"):
        start = day - timedelta(days=(day.weekday() - week_starts) % 7) + timedelta(weeks=by)
        return start, start + timedelta(weeks=1)
    if kind.endswith("Month"):
        return _month(day, by), _month(day, by + 1)
    start = day.replace(year=day.year + by, month=1, day=1)
    return start, start.replace(year=start.year + 1)
