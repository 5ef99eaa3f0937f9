from datetime import date, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.partitioning import (
    DEFAULT,
    PART,
    ExpressionPartitions,
    ListPartitions,
    RangePartitions,
    Segment,
    Step,
    add_months,
    part_start,
    partitions_from_json,
    prune,
    route,
)

MIXED = RangePartitions.of(
    "dt", ("2020-01-01", "2023-01-01", "1 year"), ("2023-01-01", "2023-08-01", "1 mon")
)


def spec(*segments):
    return RangePartitions.of("dt", *segments)


def test_ranges_of_mixed_segments():
    ranges = MIXED.ranges()
    assert len(ranges) == 10
    assert (ranges[0].start, ranges[0].end) == (date(2020, 1, 1), date(2021, 1, 1))
    assert (ranges[-1].start, ranges[-1].end) == (date(2023, 7, 1), date(2023, 8, 1))


def test_last_range_of_a_segment_may_be_short():
    assert spec(("2020-01-01", "2021-06-01", "1 year")).ranges()[-1].end == date(2021, 6, 1)


@pytest.mark.parametrize(
    "segment, key, names",
    [
        (("2023-01-01", "2023-02-01", "1 mon"), "2023-03-15", ["m_02_2023", "m_03_2023"]),
        (("2023-02-01", "2023-03-01", "1 mon"), "2023-03-01", ["m_03_2023"]),
        (("2023-01-01", "2023-01-15", "14 days"), "2023-01-16", ["d_15_01_2023", "d_16_01_2023"]),
        (("2023-01-01", "2023-04-01", "3 mon"), "2023-09-30", ["q_2_2023", "q_3_2023"]),
        (("2023-06-01", "2023-09-01", "3 mon"), "2023-09-01", ["q_3_2023"]),
        (("2023-01-01", "2023-04-05", "94 days"), "2024-04-05", ["y_2023", "y_2024"]),
        (("2020-01-01", "2021-01-01", "1 year"), "2022-12-31", ["y_2021", "y_2022"]),
        (("2023-01-01", "2023-02-01", "1 mon"), "2023-01-31 23:00:00", []),
        (("2023-01-01", "2023-02-01", "1 mon"), "2023-02-01", ["m_02_2023"]),
    ],
)
def test_extension_step_follows_the_last_partition(segment, key, names):
    grown, added = spec(segment).extend(key)
    assert [p.name for p in added] == names
    assert grown.ranges()[-1].end == (added[-1].end if added else spec(segment).last().end)
    assert len(grown.ranges()) == len(spec(segment).ranges()) + len(names)


def test_extension_without_named_partitions_does_nothing():
    empty = RangePartitions("dt")
    assert empty.extend("2023-01-01") == (empty, [])
    assert empty.open_ended() == empty


def test_overlap_is_closed_and_truncates_to_seconds():
    def labels(low, high):
        return [p.label for p in MIXED.overlapping(low, high)]

    assert labels("2022-12-31 23:59:59", "2023-01-01") == ["2022-01-01", "2023-01-01"]
    assert labels("2023-01-31 23:59:59.9", "2023-01-31 23:59:59.9") == ["2023-01-01"]
    assert labels("2010-01-01", "2011-01-01") == []
    assert labels("2023-08-01", "2024-01-01") == []
    assert labels(None, None) == []
    assert MIXED.holding("2021-05-05").label == "2021-01-01"
    assert MIXED.holding("2031-05-05") is None


@pytest.mark.parametrize(
    "bad",
    [
        [("2023-02-01", "2023-01-01", "1 mon")],
        [("2023-01-31", "2023-05-31", "1 mon")],
        [("2023-01-01", "2023-05-01", "1 mon"), ("2023-04-01", "2023-06-01", "1 mon")],
        [("2023-01-01", "2023-05-01", "1 week")],
        [("2023-01-01", "2023-05-01", "0 days")],
    ],
)
def test_bad_segments(bad):
    with pytest.raises(ValueError):
        spec(*bad)


def test_json_round_trip():
    for each in (
        MIXED,
        MIXED.extend("2024-01-01")[0],
        RangePartitions("k"),
        ListPartitions("g", ("a", "it's")),
        ExpressionPartitions.monthly("dt"),
    ):
        assert partitions_from_json(each.to_json()) == each


def test_add_months_clamps():
    assert add_months(date(2024, 1, 31), 1) == date(2024, 2, 29)
    assert add_months(date(2023, 12, 31), 2) == date(2024, 2, 29)
    assert add_months(date(2024, 3, 15), -3) == date(2023, 12, 15)


SPECS = [
    MIXED,
    spec(("2020-01-15", "2023-01-15", "1 mon")),
    spec(("2020-03-10", "2024-03-10", "1 year")),
    spec(("2020-02-01", "2023-02-01", "3 mon")),
    spec(("2020-01-01", "2023-01-01", "3 mon")),
    spec(("2020-01-01", "2020-03-01", "7 days"), ("2020-03-01", "2021-01-01", "1 day")),
    spec(("2020-01-01", "2021-06-01", "1 year")),
    spec(("2019-11-01", "2021-11-01", "4 mon")),
]


@pytest.mark.parametrize("partitioning", SPECS)
def test_routing_agrees_with_the_ranges(spark, partitioning):
    keys = [datetime(2019, 1, 1) + timedelta(hours=37 * i) for i in range(1200)]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "dt timestamp_ntz")
    routed = route(df, partitioning).withColumn("start", part_start(partitioning)).collect()
    ranges = partitioning.ranges()
    for row in routed:
        home = [p for p in ranges if row.dt and p.start <= row.dt.date() < p.end]
        assert row[PART] == (home[0].label if home else DEFAULT)
        assert (row.start.date() if row.start else None) == (home[0].start if home else None)


@pytest.mark.parametrize("partitioning", SPECS)
def test_open_ended_routing_foresees_the_extension(spark, partitioning):
    top = datetime(2026, 5, 5)
    keys = [top - timedelta(days=11 * i) for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "dt timestamp_ntz")
    ahead = route(df, partitioning.open_ended()).withColumnRenamed(PART, "ahead")
    both = route(ahead, partitioning.extend(top)[0])
    assert both.filter(F.col("ahead") != F.col(PART)).count() == 0


@given(st.dates(date(1990, 1, 1), date(2040, 1, 1)), st.integers(1, 40), st.integers(0, 2000))
def test_extension_covers_the_key_and_leaves_no_gap(start, days, ahead):
    base = RangePartitions("dt", (Segment(start, start + timedelta(days=days), Step(days=days)),))
    if start.day > 28:
        return
    try:
        grown, added = base.extend(start + timedelta(days=ahead))
    except ValueError:
        # Growing by months from the end of a month has no fixed day.
        assert base.last().end.day > 28
        return
    assert grown.last().end > start + timedelta(days=ahead)
    chain = [base.last(), *added]
    assert all(a.end == b.start for a, b in zip(chain, chain[1:]))


def test_prune_reads_only_the_partitions_of_the_range(spark, tmp_path):
    keys = [(datetime(2022, 11, 1) + timedelta(days=i),) for i in range(300)]
    path = str(tmp_path / "t")
    route(spark.createDataFrame(keys, "dt timestamp_ntz"), MIXED).write.partitionBy(PART).parquet(
        path
    )
    table = spark.read.schema(f"dt timestamp_ntz, {PART} string").parquet(path)
    lower, upper = datetime(2023, 2, 10), datetime(2023, 3, 5)
    found = prune(table, MIXED, lower, upper)
    assert found.count() == (upper - lower).days
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2023-02-01" in plan
