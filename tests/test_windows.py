from datetime import date, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.intervals import LoadInterval, SafetyPeriod, to_datetime
from tidemark.plans.windows import (
    Window,
    adjusted,
    next_window,
    next_windows,
    range_days,
    split_predicates,
    split_window,
)

INTERVALS = ["1 mon", "2 months", "3 days", "1 DAY", "1 year", "5 hours", "2 weeks", "", "day", "x mon"]
SAFETY = ["0 days", "2 days", "1 month", "3 Months", "1 mon", "7", ""]
NOW = datetime(2024, 5, 17, 13, 45, 10, 250000)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-31", datetime(2025, 1, 31)),
        ("2025-01-31 08:05:00", datetime(2025, 1, 31, 8, 5)),
        ("2025-01-31T08:05:00", datetime(2025, 1, 31, 8, 5)),
        ("2025-01-31 08:05:00.75", datetime(2025, 1, 31, 8, 5)),
        (date(2025, 1, 31), datetime(2025, 1, 31)),
        (datetime(2025, 1, 31, 8, 5, 0, 9), datetime(2025, 1, 31, 8, 5)),
        (None, None),
    ],
)
def test_date_input(text, expected):
    assert to_datetime(text) == expected


@pytest.mark.parametrize("bad", ["2025/01/31", "tomorrow", 20250131])
def test_bad_date_input(bad):
    with pytest.raises(ValueError):
        to_datetime(bad)


def test_interval_rules():
    start, end = datetime(2024, 2, 29, 10, 30, 5), datetime(2024, 3, 31, 10, 30, 5)
    rules = {
        "1 mon": (datetime(2024, 2, 1), datetime(2024, 4, 1)),
        "2 months": (datetime(2024, 2, 1), datetime(2024, 5, 2)),
        "3 days": (datetime(2024, 2, 29), datetime(2024, 4, 3)),
        "1 year": (datetime(2024, 1, 1), datetime(2024, 12, 31)),
        "5 hours": (datetime(2024, 2, 29, 10), datetime(2024, 3, 31, 15)),
        "2 weeks": (start, end),
        "": (start, end),
    }
    for text, expected in rules.items():
        assert LoadInterval.parse(text).adjust(start, end) == expected, text


def test_safety_rules():
    moment = datetime(2024, 3, 31)
    assert SafetyPeriod.parse("2 days").shift(moment) == datetime(2024, 3, 29)
    assert SafetyPeriod.parse("2 months").shift(moment) == moment - timedelta(days=62)
    assert SafetyPeriod.parse("1 mon").shift(moment) == moment
    assert SafetyPeriod.parse("2 days").shift(None) == datetime(2000, 1, 1)


def test_window_order():
    assert next_window(None, NOW) == Window(datetime(2000, 1, 1), NOW)
    assert next_window(datetime(1970, 1, 1), NOW, delta_start="2019-01-01").lower.year == 2019
    assert next_window(datetime(2024, 5, 1), NOW).lower == datetime(2024, 5, 1)
    chosen = next_window(datetime(2024, 5, 1), NOW, start="2021-01-01", end="2021-02-01")
    assert chosen == Window(datetime(2021, 1, 1), datetime(2021, 2, 1))
    half = next_window(datetime(2024, 5, 1), NOW, start="2021-01-01")
    assert half.upper == NOW
    both = next_window(datetime(2024, 5, 20), NOW, "1 mon", "3 days")
    assert both == Window(datetime(2024, 4, 28), datetime(2024, 6, 1))


def test_columns_agree_with_scalars(spark):
    moments = [
        datetime(2000, 2, 29, 23, 59, 59, 999999),
        datetime(1969, 12, 31, 1, 2, 3),
        datetime(2024, 3, 31, 2, 30),
        datetime(2024, 12, 31),
        datetime(1999, 1, 1, 0, 0, 1),
    ]
    rows = [(a, b) for a in moments for b in moments]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    columns, expected = [], []
    for i, interval in enumerate(INTERVALS):
        for j, safety in enumerate(SAFETY):
            low, high = adjusted(F.col("a"), F.col("b"), interval, safety)
            columns += [low.alias(f"l{i}_{j}"), high.alias(f"h{i}_{j}")]
    for a, b in rows:
        line = []
        for interval in INTERVALS:
            for safety in SAFETY:
                low, high = LoadInterval.parse(interval).adjust(a, b)
                line += [SafetyPeriod.parse(safety).shift(low), high]
        expected.append(tuple(line))
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [tuple(r) for r in df.select("a", "b", *columns).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        found = {(r[0], r[1]): r[2:] for r in got}
        assert [found[key] for key in rows] == expected


def test_next_windows_agree_with_scalar(spark):
    marks = [("a", datetime(2024, 1, 15, 3)), ("b", None), ("c", datetime(1970, 1, 1))]
    df = spark.createDataFrame(marks, "object_name string, extraction_to timestamp_ntz")
    got = next_windows(df, NOW, "1 mon", "2 days", "2010-03-04").collect()
    for row, (_, mark) in zip(sorted(got), marks):
        want = next_window(mark, NOW, "1 mon", "2 days", "2010-03-04")
        assert (row.extraction_from, row.extraction_to) == (want.lower, want.upper)


days = st.datetimes(min_value=datetime(1990, 1, 1), max_value=datetime(2030, 1, 1))


@given(days, st.timedeltas(timedelta(0), timedelta(days=4000)), st.integers(1, 40))
def test_sub_ranges_tile_the_window(lower, length, nodes):
    window = Window(lower, lower + length)
    parts = split_window(window, nodes)
    assert parts[0].lower == window.lower and parts[-1].upper == window.upper
    for left, right in zip(parts, parts[1:]):
        assert left.upper == right.lower
        assert left.upper - left.lower == timedelta(days=range_days(window, nodes))


def test_split_example():
    window = Window(datetime(2000, 1, 1), datetime(2001, 1, 1))
    assert range_days(window) == 22
    predicates = split_predicates("o_orderdate", window)
    assert len(predicates) == 17
    assert predicates[0] == (
        "o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' "
        "AND o_orderdate < TIMESTAMP '2000-01-23 00:00:00'"
    )
    assert predicates[-1].endswith("o_orderdate <= TIMESTAMP '2001-01-01 00:00:00'")
