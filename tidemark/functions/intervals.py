"""Load intervals, safety periods and date input.

Each rule exists twice: on Python datetimes (one window per run, computed on
the driver) and on columns (many windows at once). Months count 31 days and
years 365 days when they are added, by definition of the load interval.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FALLBACK_START = datetime(2000, 1, 1)
EMPTY_MARK = datetime(1970, 1, 1)
DAYS_PER_MONTH = 31
DAYS_PER_YEAR = 365

NTZ = "timestamp_ntz"


def to_datetime(value: str | date | datetime | None) -> datetime | None:
    """Accepts ``2025-01-31``, ``2025-01-31 08:00:00``, the same with a ``T``,
    and date or datetime objects; fractions of a second are dropped."""
    if value is None:
        return None
    if isinstance(value, datetime):
        return value.replace(microsecond=0, tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, str):
        text = value.strip().replace("T", " ").split(".")[0]
        pattern = "%Y-%m-%d %H:%M:%S" if " " in text else "%Y-%m-%d"
        return datetime.strptime(text, pattern)
    raise ValueError(f"expected a date, a datetime or a string, got {value!r}")


def as_moment(value: date | datetime | None) -> datetime | None:
    """A date as its midnight; a datetime as it is."""
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return value


def _leading_int(text: str) -> int:
    try:
        return int(text)
    except ValueError:
        return 0


@dataclass(frozen=True)
class LoadInterval:
    """``"1 mon"``, ``"3 days"``, ``"5 hours"``, ``"1 year"``; other units
    leave both ends of a window as they are."""

    count: int = 0
    unit: str = ""

    @classmethod
    def parse(cls, text: str | None) -> LoadInterval:
        words = (text or "").lower().split()
        if len(words) < 2:
            return cls()
        for unit, token in (("month", "mon"), ("day", "day"), ("year", "year"), ("hour", "hour")):
            if token in words[1]:
                return cls(_leading_int(words[0]), unit)
        return cls()

    def _floor(self, moment: datetime) -> datetime:
        if self.unit == "hour":
            return moment.replace(minute=0, second=0, microsecond=0)
        midnight = moment.replace(hour=0, minute=0, second=0, microsecond=0)
        if self.unit == "month":
            return midnight.replace(day=1)
        if self.unit == "year":
            return midnight.replace(month=1, day=1)
        return midnight if self.unit == "day" else moment

    def _span(self) -> timedelta:
        days = {"day": 1, "month": DAYS_PER_MONTH, "year": DAYS_PER_YEAR}.get(self.unit, 0)
        hours = self.count if self.unit == "hour" else 0
        return timedelta(days=days * self.count, hours=hours)

    def adjust(self, start: datetime, end: datetime) -> tuple[datetime, datetime]:
        return self._floor(start), self._floor(end) + self._span()

    def floor_column(self, moment: Column) -> Column:
        """Begin of the unit, on wall-clock timestamps in any session zone."""
        if not self.unit:
            return moment
        if self.unit == "hour":
            return moment - F.make_dt_interval(
                mins=F.minute(moment), secs=F.extract(F.lit("SECOND"), moment)
            )
        day = moment.cast("date")
        return (day if self.unit == "day" else F.trunc(day, self.unit)).cast(NTZ)

    def adjust_columns(self, start: Column, end: Column) -> tuple[Column, Column]:
        span = self._span()
        upper = self.floor_column(end)
        if span:
            upper = upper + F.lit(span)
        return self.floor_column(start), upper


@dataclass(frozen=True)
class SafetyPeriod:
    """``"2 days"`` or ``"1 month"``: how far a window's start moves back."""

    days: int = 0

    @classmethod
    def parse(cls, text: str | None) -> SafetyPeriod:
        lowered = (text or "").lower()
        count = _leading_int(lowered.split(" ")[0])
        if "day" in lowered:
            return cls(count)
        if "month" in lowered:
            return cls(count * DAYS_PER_MONTH)
        return cls()

    def shift(self, moment: datetime | None) -> datetime:
        if moment is None:
            return FALLBACK_START
        return moment - timedelta(days=self.days)

    def shift_column(self, moment: Column) -> Column:
        moved = moment - F.lit(timedelta(days=self.days)) if self.days else moment
        return F.coalesce(moved, F.lit(FALLBACK_START.isoformat(sep=" ")).cast(NTZ))
