"""Instants, local time and calendar features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.plans.spans import Days

OFFSET = r"(?i)(z|[+-]\d{2}:?\d{2})\s*$"


def to_instant(text: Column, zone: str = "UTC") -> Column:
    """Text as an instant: with its own offset if it has one, else as wall-clock time of zone.

    Null for what doesn't parse. An ambiguous hour is its first pass; a skipped one moves forward.
    """
    text = text.cast("string")
    return F.when(text.rlike(OFFSET), F.try_to_timestamp(text)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(text), zone))


def local_time(ts: Column, zone: str) -> Column:
    """Wall-clock time without zone, so that it can't be taken for an instant."""
    return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")


def epoch(ts: Column) -> Column:
    return ts.cast("timestamp").cast("long")


def within(ts: Column, window: Days, keep_null: bool = False) -> Column:
    """Instants from the window's first day up to, not including, the day after it."""
    inside = (ts >= F.lit(window.start)) & (ts < F.lit(window.stop))
    return inside | ts.isNull() if keep_null else inside


def within_days(day: Column, window: Days) -> Column:
    return day.between(F.lit(window.start), F.lit(window.end))


def within_local_days(ts: Column, zone: str, window: Days) -> Column:
    """Local days of a window, with a wider range of instants in front that scans can push down."""
    wide = (ts >= F.lit(window.start - timedelta(days=1))) & (ts < F.lit(window.stop + timedelta(days=1)))
    return wide & within_days(F.to_date(local_time(ts, zone)), window)


def in_months(window: Days, year: str = "year", month: str = "month") -> Column:
    """Partition predicate for year and month columns; becomes a partition filter of the scan."""
    return (F.col(year) * 100 + F.col(month)).isin([y * 100 + m for y, m in window.months()])


def calendar(ts: Column) -> dict[str, Column]:
    """Hour, day of week (Sunday is 1), month and weekend flag."""
    dow = F.dayofweek(ts)
    return {"hour": F.hour(ts), "dow": dow, "month": F.month(ts), "is_weekend": dow.isin(1, 7).cast("int")}


def is_holiday(day: Column, holidays: Sequence[str]) -> Column:
    """1 on listed days (ISO dates), else 0; with an empty list a constant 0."""
    return F.date_format(day, "yyyy-MM-dd").isin(list(holidays)).cast("int") if holidays else F.lit(0)
