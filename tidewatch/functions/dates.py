"""Business dates and date windows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import types as T

BUSINESS_ZONE = "America/Los_Angeles"
_MICROS_PER_DAY = 24 * 3600 * 1_000_000


def as_date(value: str | dt.date) -> dt.date:
    """Parse ``YYYY-MM-DD``; anything else raises ``ValueError``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def business_date(name: str, dtype: T.DataType) -> str:
    """SQL for a column's calendar date in the business zone, under any session time zone.

    A ``TIMESTAMP_NTZ`` is taken to hold UTC. The shift is done on microseconds since the
    epoch: casts between the two timestamp types would go through the session zone, and
    ``convert_timezone`` looks its zones up by name for every row, which costs several times
    as much.
    """
    if isinstance(dtype, T.DateType):
        return name
    if isinstance(dtype, T.TimestampNTZType):
        epoch = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
        name = f"timestamp_micros(timestampdiff(MICROSECOND, {epoch}, {name}))"
    elif not isinstance(dtype, T.TimestampType):
        raise TypeError(f"expected a date or timestamp column, got {dtype.simpleString()}")
    shifted = f"unix_micros(from_utc_timestamp({name}, '{BUSINESS_ZONE}'))"
    return f"date_from_unix_date(int(floor({shifted} / {_MICROS_PER_DAY})))"


def day_start_utc(day: dt.date) -> dt.datetime:
    """The UTC instant at which ``day`` starts in the business zone."""
    local = dt.datetime.combine(day, dt.time(), tzinfo=ZoneInfo(BUSINESS_ZONE))
    return local.astimezone(dt.timezone.utc)


def _instant(day: dt.date, dtype: T.DataType) -> str:
    start = f"{day_start_utc(day):%Y-%m-%d %H:%M:%S}"
    if isinstance(dtype, T.TimestampType):
        return f"TIMESTAMP '{start}+00:00'"
    return f"TIMESTAMP_NTZ '{start}'"


@dataclass(frozen=True)
class DateWindow:
    """An inclusive range of business dates, or chosen days inside it; ``None`` leaves an end open."""

    start: dt.date | None
    end: dt.date | None
    days: tuple[dt.date, ...] | None = None

    @classmethod
    def lookback(cls, report_date: dt.date, days: int) -> DateWindow:
        return cls(report_date - dt.timedelta(days=days), report_date)

    @classmethod
    def always(cls) -> DateWindow:
        return cls(None, None)

    def only(self, *days: dt.date) -> DateWindow:
        """The same window narrowed to some days; days outside it are left out."""
        first, last = self.start or dt.date.min, self.end or dt.date.max
        inside = sorted({d for d in days if first <= d <= last})
        return DateWindow(self.start, self.end, tuple(inside))

    def all_days(self) -> list[dt.date] | None:
        """Every day of the window; None if an end is open."""
        if self.days is not None:
            return list(self.days)
        if self.start is None or self.end is None:
            return None
        return [self.start + dt.timedelta(days=n) for n in range((self.end - self.start).days + 1)]

    def _ranges(self) -> list[tuple[dt.date | None, dt.date | None]]:
        if self.days is None:
            return [(self.start, self.end)]
        ranges: list[tuple[dt.date, dt.date]] = []
        for day in self.days:
            if ranges and day == ranges[-1][1] + dt.timedelta(days=1):
                ranges[-1] = (ranges[-1][0], day)
            else:
                ranges.append((day, day))
        return ranges

    def covers(self, name: str, dtype: T.DataType) -> str:
        """SQL predicate on the stored column, so that Parquet can skip row groups.

        For timestamps this compares the raw column with the UTC instants at which the
        business days start and end. The business zone never changes its clocks at
        midnight, so this keeps exactly the rows whose business date is in the window.
        """
        is_date = isinstance(dtype, T.DateType)
        tests = []
        for first, last in self._ranges():
            bounds = []
            if first is not None:
                bounds.append(f"{name} >= " + (f"DATE '{first}'" if is_date else _instant(first, dtype)))
            if last is not None:
                after = last + dt.timedelta(days=1)
                bounds.append(f"{name} < " + (f"DATE '{after}'" if is_date else _instant(after, dtype)))
            tests.append(f"({' AND '.join(bounds) or 'true'})")
        return " OR ".join(tests) or "false"
