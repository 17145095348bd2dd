"""Windows of days and months, without Spark."""

from __future__ import annotations

import calendar
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta


def parse_day(x: str | date) -> date:
    if isinstance(x, datetime):
        return x.date()
    return x if isinstance(x, date) else date.fromisoformat(x[:10])


@dataclass(frozen=True)
class Days:
    """Days from start to end, both included."""

    start: date
    end: date

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError(f"window ends on {self.end}, before its start {self.start}")

    @classmethod
    def between(cls, start: str | date, end: str | date) -> Days:
        return cls(parse_day(start), parse_day(end))

    @property
    def stop(self) -> date:
        """The first day after the window."""
        return self.end + timedelta(days=1)

    @property
    def days(self) -> int:
        return (self.stop - self.start).days

    def months(self) -> Iterator[tuple[int, int]]:
        at = self.start.year * 12 + self.start.month - 1
        while at <= self.end.year * 12 + self.end.month - 1:
            yield at // 12, at % 12 + 1
            at += 1

    def widen(self, before: int, after: int) -> Days:
        return Days(self.start - timedelta(days=before), self.end + timedelta(days=after))

    def whole_months(self) -> Days:
        """Whole months: what an overwrite of month partitions must cover."""
        last = calendar.monthrange(self.end.year, self.end.month)[1]
        return Days(self.start.replace(day=1), self.end.replace(day=last))


@dataclass(frozen=True)
class Reach:
    """Hours that features look back and ahead, in whole days of reading."""

    lags: tuple[int, ...] = (24, 48, 168)
    rolling: int = 24
    lead: int = 24

    @property
    def lookback(self) -> int:
        return -(-max((*self.lags, self.rolling)) // 24) + 1

    @property
    def lookahead(self) -> int:
        return -(-self.lead // 24)


def days_to_read(requested: Days, span: Reach) -> Days:
    """What must be read to write whole months of the request with complete features."""
    return requested.whole_months().widen(span.lookback, span.lookahead)


def scheduled_days(params: dict, interval_start: datetime, interval_end: datetime) -> Days:
    """Month-aligned window of a scheduled run; params month and month_end (YYYY-MM) override the interval."""
    if params.get("month"):
        first = parse_day(params["month"] + "-01")
        return Days(first, parse_day((params.get("month_end") or params["month"]) + "-01")).whole_months()
    last = max(interval_start, interval_end - timedelta(microseconds=1))
    return Days.between(interval_start, last).whole_months()
