"""Extraction windows: which time range of a source is read next."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import (
    EMPTY_MARK,
    FALLBACK_START,
    LoadInterval,
    SafetyPeriod,
    to_datetime,
)
from tidemark.operators.filters import moment

DEFAULT_NODES = 16


@dataclass(frozen=True)
class Window:
    lower: datetime
    upper: datetime


def next_window(
    last: datetime | None,
    now: datetime,
    load_interval: str = "",
    safety_period: str = "0 days",
    delta_start=None,
    start=None,
    end=None,
) -> Window:
    """A range given by the user (both ends needed) wins; otherwise the window
    runs from the last high-water mark to now. The load interval widens both
    ends, the safety period then moves the start back."""
    if start is not None and end is not None:
        lower, upper = to_datetime(start), to_datetime(end)
    else:
        lower = last if last is not None and last != EMPTY_MARK else None
        lower = lower or to_datetime(delta_start) or FALLBACK_START
        upper = now
    lower, upper = LoadInterval.parse(load_interval).adjust(lower, upper)
    return Window(SafetyPeriod.parse(safety_period).shift(lower), upper)


def adjusted(
    start: Column, end: Column, load_interval: str = "", safety_period: str = "0 days"
) -> tuple[Column, Column]:
    """The interval and safety rules of ``next_window`` on columns."""
    lower, upper = LoadInterval.parse(load_interval).adjust_columns(start, end)
    return SafetyPeriod.parse(safety_period).shift_column(lower), upper


def next_windows(
    marks: DataFrame,
    now: datetime,
    load_interval: str = "",
    safety_period: str = "0 days",
    delta_start=None,
) -> DataFrame:
    """``next_window`` for every object of a frame of high-water marks with the
    columns ``object_name`` and ``extraction_to``."""
    first = moment(to_datetime(delta_start) or FALLBACK_START)
    last = F.col("extraction_to")
    known = F.when(last.isNotNull() & (last != moment(EMPTY_MARK)), last).otherwise(first)
    lower, upper = adjusted(known, moment(now), load_interval, safety_period)
    return marks.select(
        "object_name", lower.alias("extraction_from"), upper.alias("extraction_to")
    )


# -- parallel extraction ---------------------------------------------------------


def range_days(window: Window, nodes: int = DEFAULT_NODES) -> int:
    total = (window.upper - window.lower).total_seconds() / 86400
    return max(1, int(total // nodes))


def split_window(window: Window, nodes: int = DEFAULT_NODES) -> list[Window]:
    """Sub-ranges of whole days. Each is half-open but the last, which holds
    its upper end, so that together they equal the closed window."""
    step = timedelta(days=range_days(window, nodes))
    out, lower = [], window.lower
    while lower < window.upper:
        out.append(Window(lower, min(lower + step, window.upper)))
        lower += step
    return out or [window]


def split_predicates(column: str, window: Window, nodes: int = DEFAULT_NODES) -> list[str]:
    """One SQL predicate per sub-range, for a JDBC reader."""
    ranges = split_window(window, nodes)
    out = []
    for i, part in enumerate(ranges):
        closing = "<=" if i == len(ranges) - 1 else "<"
        out.append(
            f"{column} >= TIMESTAMP '{part.lower}' AND {column} {closing} TIMESTAMP '{part.upper}'"
        )
    return out


def rows_per_range(
    df: DataFrame, column: str, window: Window, nodes: int = DEFAULT_NODES
) -> DataFrame:
    """How the rows of a window fall on its sub-ranges."""
    days = range_days(window, nodes)
    last = len(split_window(window, nodes)) - 1
    low, high = moment(window.lower), moment(window.upper)
    seconds = F.timestamp_diff("SECOND", low, F.col(column))
    index = F.least(F.floor(seconds / (86400 * days)).cast("int"), F.lit(last))
    counted = (
        df.filter(F.col(column).between(low, high))
        .groupBy(index.alias("i"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    begin = low + F.make_dt_interval(days=F.col("i") * days)
    return counted.select(
        begin.alias("lo"),
        F.least(begin + F.expr(f"INTERVAL {days} DAYS"), high).alias("hi"),
        "n",
    )
