"""Logical partitions of a target table.

A partition is stored under a text label in the column ``PART``: the first day
of a date range (``2001-03-01``), the value of an expression (``200103``) or a
listed value, the latter two written so that every catalog shows them as they
are (``stored_label``). Rows outside every range or list, and NULL keys, carry
the label ``DEFAULT``. Specs are small driver-side values; routing is a column expression
with one branch per segment, whatever the number of partitions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import NTZ, to_datetime

PART = "_part"
DEFAULT = "__default__"
END_OF_TIME = date(9999, 12, 31)

#: What stands for an empty label and for a leading underscore.
EMPTY_LABEL, UNDERSCORE = "~", "~5F"

_EVERY = re.compile(r"^\s*(\d+)\s*(day|mon|month|year)s?\s*$", re.IGNORECASE)


def stored_label(value: Column) -> Column:
    """A value as a partition label of letters, digits and ``-._+~`` only.

    Anything else would be escaped by catalogs and file systems, each in its own
    way, and a label read back would not be the label that was written. Other
    characters become ``~`` and their UTF-8 bytes in hexadecimal, blanks ``+``.
    Different values get different labels, and none that of the default partition.
    Values that need none of this, as most do, pass after one look at them.
    """
    safe = F.replace(F.translate(F.url_encode(value), "%", "~"), F.lit("*"), F.lit("~2A"))
    safe = F.when(safe.startswith("_"), F.concat(F.lit(UNDERSCORE), F.substring(safe, 2, 1 << 30))).otherwise(safe)
    plain = value.rlike(r"^[A-Za-z0-9.\-][A-Za-z0-9._\-]*\z")
    return F.when(plain, value).when(value == "", EMPTY_LABEL).otherwise(safe)


def add_months(day: date, months: int) -> date:
    """Calendar months, clamped to the end of the month; ``END_OF_TIME`` at most."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    if (year, month) >= (END_OF_TIME.year, 11):
        return min(END_OF_TIME, date(min(year, 9999), month + 1, min(day.day, 28)) if year < 10000 else END_OF_TIME)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(day.day, (following - timedelta(days=1)).day))


@dataclass(frozen=True)
class Step:
    days: int = 0
    months: int = 0

    @classmethod
    def parse(cls, text: str) -> Step:
        match = _EVERY.match(text)
        if not match or int(match.group(1)) < 1:
            raise ValueError(f"cannot read partition step {text!r}")
        count, unit = int(match.group(1)), match.group(2).lower()
        if unit == "day":
            return cls(days=count)
        return cls(months=count * (12 if unit == "year" else 1))

    def after(self, day: date, times: int = 1) -> date:
        if self.months:
            return add_months(day, self.months * times)
        left = (END_OF_TIME - day).days
        return day + timedelta(days=min(self.days * times, left))

    def times_beyond(self, day: date, top: date) -> int:
        """The least number of steps from ``day`` to beyond ``top``."""
        if self.days:
            return (top - day).days // self.days + 1
        months = (top.year - day.year) * 12 + top.month - day.month
        times = max(1, months // self.months)
        while self.after(day, times) <= top:
            times += 1
        return times


@dataclass(frozen=True)
class Segment:
    """Consecutive partitions ``[start, end)`` of one step length."""

    start: date
    end: date
    step: Step

    def __post_init__(self):
        if self.end <= self.start:
            raise ValueError(f"segment ends ({self.end}) before it starts ({self.start})")
        if self.step.months and self.start.day > 28:
            raise ValueError("a segment of months must start on day 1 to 28")

    def ranges(self) -> list[tuple[date, date]]:
        out, low = [], self.start
        while low < self.end:
            high = self.step.after(low)
            out.append((low, min(high, self.end)))
            low = high
        return out

    def _aligned_unit(self) -> str | None:
        """Calendar unit whose beginnings are exactly the partition starts."""
        first = self.start
        if self.step.days == 1:
            return "day"
        if first.day == 1 and self.step.months == 1:
            return "month"
        if first.day == 1 and self.step.months == 3 and first.month % 3 == 1:
            return "quarter"
        if first.day == 1 and self.step.months == 12 and first.month == 1:
            return "year"
        return None

    def start_of(self, day: Column) -> Column:
        """First day of the partition that holds ``day`` (a date column)."""
        unit = self._aligned_unit()
        if unit:
            return day if unit == "day" else F.trunc(day, unit)
        origin = F.lit(self.start)
        if self.step.days:
            past = F.floor(F.date_diff(day, origin) / self.step.days).cast("int")
            return F.date_add(origin, past * self.step.days)
        whole = (
            (F.year(day) - self.start.year) * 12
            + F.month(day)
            - self.start.month
            - F.when(F.dayofmonth(day) < self.start.day, 1).otherwise(0)
        )
        past = F.floor(whole / self.step.months).cast("int")
        return F.add_months(origin, past * self.step.months)


@dataclass(frozen=True)
class RangePartition:
    name: str
    start: date
    end: date

    @property
    def label(self) -> str:
        return self.start.isoformat()


@dataclass(frozen=True)
class RangePartitions:
    """Date-range partitions plus a default one. Without segments everything
    lives in the default partition, and the key may have any type."""

    key: str
    segments: tuple[Segment, ...] = ()

    def __post_init__(self):
        ordered = sorted(self.segments, key=lambda s: s.start)
        for left, right in zip(ordered, ordered[1:]):
            if right.start < left.end:
                raise ValueError("partition segments overlap")
        object.__setattr__(self, "segments", tuple(ordered))

    @classmethod
    def of(cls, key: str, *segments: tuple[str, str, str]) -> RangePartitions:
        """``of("dt", ("1996-01-01", "2000-01-01", "1 year"), ...)``"""
        return cls(
            key,
            tuple(
                Segment(to_datetime(a).date(), to_datetime(b).date(), Step.parse(every))
                for a, b, every in segments
            ),
        )

    # -- routing -------------------------------------------------------------

    def start_of(self, key: Column | None = None) -> Column:
        """Partition start as a date; NULL stands for the default partition."""
        if not self.segments:
            return F.lit(None).cast("date")
        day = (F.col(self.key) if key is None else key).cast("date")
        out = None
        for segment in self.segments:
            inside = (day >= F.lit(segment.start)) & (day < F.lit(segment.end))
            value = segment.start_of(day)
            out = F.when(inside, value) if out is None else out.when(inside, value)
        return out

    def label(self) -> Column:
        return F.coalesce(self.start_of().cast("string"), F.lit(DEFAULT))

    # -- lookups on the spec ---------------------------------------------------

    def ranges(self) -> list[RangePartition]:
        return [
            RangePartition(_name(low, segment.step), low, high)
            for segment in self.segments
            for low, high in segment.ranges()
        ]

    def last(self) -> RangePartition | None:
        return max(self.ranges(), key=lambda p: p.end, default=None)

    def overlapping(self, lowest, highest) -> list[RangePartition]:
        """Named partitions that a closed key interval touches, in order."""
        if not self.segments:
            return []
        low, high = to_datetime(lowest), to_datetime(highest)
        if low is None or high is None:
            return []
        return [
            p
            for p in self.ranges()
            if to_datetime(p.start) <= high and to_datetime(p.end) - timedelta(seconds=1) >= low
        ]

    def holding(self, value) -> RangePartition | None:
        found = self.overlapping(value, value)
        return found[0] if found else None

    # -- growth ----------------------------------------------------------------

    def growth_step(self) -> Step | None:
        """Step of new partitions, read off the length of the last one."""
        last = self.last()
        if last is None:
            return None
        # Lengths in days that tell days, months, quarters and years apart.
        days = (last.end - last.start).days
        if days < 28:
            return Step(days=1)
        if days <= 31:
            return Step(months=1)
        return Step(months=3) if days <= 92 else Step(months=12)

    def extend(self, highest) -> tuple[RangePartitions, list[RangePartition]]:
        """Add partitions after the last one until ``highest`` is covered."""
        last, step = self.last(), self.growth_step()
        if last is None:
            return self, []
        top = to_datetime(highest)
        if top is None or last.end > top.date() or last.end >= END_OF_TIME:
            return self, []
        # The end of time marks open rows; no partition is made for it.
        day = min(top.date(), END_OF_TIME - timedelta(days=1))
        end = step.after(last.end, step.times_beyond(last.end, day))
        added = Segment(last.end, end, step)
        tail = self.segments[-1]
        if tail.step == step and tail.ranges()[-1][1] == step.after(tail.ranges()[-1][0]):
            grown = self.segments[:-1] + (replace(tail, end=end),)
        else:
            grown = self.segments + (added,)
        new = [RangePartition(_name(low, step), low, high) for low, high in added.ranges()]
        return replace(self, segments=grown), new

    def open_ended(self) -> RangePartitions:
        """Routing as if all future partitions existed already. Rows routed by
        this land where ``extend(max(key))`` would put them, so the highest key
        need not be known beforehand."""
        last = self.last()
        if last is None:
            return self
        tail = Segment(last.end, END_OF_TIME, self.growth_step())
        return replace(self, segments=self.segments + (tail,))

    # -- persistence -------------------------------------------------------------

    def to_json(self) -> str:
        rows = [
            [s.start.isoformat(), s.end.isoformat(), s.step.days, s.step.months]
            for s in self.segments
        ]
        return json.dumps({"kind": "range", "key": self.key, "segments": rows})


@dataclass(frozen=True)
class ListPartitions:
    """One partition per listed value of the key; the rest is default."""

    key: str
    values: tuple[str, ...]

    def label(self) -> Column:
        text = F.col(self.key).cast("string")
        return F.when(text.isin(list(self.values)), stored_label(text)).otherwise(F.lit(DEFAULT))

    def to_json(self) -> str:
        return json.dumps({"kind": "list", "key": self.key, "values": list(self.values)})


@dataclass(frozen=True)
class ExpressionPartitions:
    """One partition per value of a SQL expression over the row, for example
    ``date_format(orderdate, 'yyyyMM')``. The values must be few, as partitions
    are: each is a directory and a catalog entry, and their labels pass through
    the driver."""

    key: str
    expression: str

    @classmethod
    def monthly(cls, key: str) -> ExpressionPartitions:
        return cls(key, f"date_format(`{key}`, 'yyyyMM')")

    def label(self) -> Column:
        return F.coalesce(stored_label(F.expr(self.expression).cast("string")), F.lit(DEFAULT))

    def to_json(self) -> str:
        return json.dumps({"kind": "expression", "key": self.key, "expression": self.expression})


Partitions = RangePartitions | ListPartitions | ExpressionPartitions


def partitions_from_json(text: str) -> Partitions:
    data = json.loads(text)
    if data["kind"] == "list":
        return ListPartitions(data["key"], tuple(data["values"]))
    if data["kind"] == "expression":
        return ExpressionPartitions(data["key"], data["expression"])
    return RangePartitions(
        data["key"],
        tuple(
            Segment(date.fromisoformat(a), date.fromisoformat(b), Step(days, months))
            for a, b, days, months in data["segments"]
        ),
    )


def route(df: DataFrame, spec: Partitions) -> DataFrame:
    """Add the partition label of every row."""
    return df.withColumn(PART, spec.label())


def part_start(spec: RangePartitions) -> Column:
    """Partition start as a timestamp, NULL for the default partition."""
    return spec.start_of().cast(NTZ)


def in_labels(labels: Iterable[str]) -> Column:
    """Predicate on the partition column; prunes directories on a table scan."""
    return F.col(PART).isin(sorted(labels))


def prune(df: DataFrame, spec: RangePartitions, lower: datetime, upper: datetime) -> DataFrame:
    """Rows with a key in ``[lower, upper)``. Adds the partitions that can hold
    such rows as a predicate, so that a table scan opens only those."""
    last = to_datetime(upper) - timedelta(seconds=1)
    labels = [p.label for p in spec.overlapping(lower, last)]
    key = F.col(spec.key)
    bounded = (key >= F.lit(lower).cast(NTZ)) & (key < F.lit(upper).cast(NTZ))
    return df.filter(in_labels([*labels, DEFAULT])).filter(bounded)


def changed_partitions(delta: DataFrame, spec: Partitions) -> DataFrame:
    """Labels of the partitions that a delta brings rows for."""
    return route(delta, spec).select(PART).distinct()


def _name(start: date, step: Step) -> str:
    # Names of partitions by the length of their step.
    if step.days:
        return f"d_{start:%d_%m_%Y}"
    if step.months == 1:
        return f"m_{start:%m_%Y}"
    if step.months == 3:
        return f"q_{(start.month - 1) // 3 + 1}_{start:%Y}"
    return f"y_{start:%Y}"


def labels_of(ranges: Sequence[RangePartition]) -> set[str]:
    return {p.label for p in ranges}
