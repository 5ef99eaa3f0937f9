"""Key ranges of partitions: what an upsert leaves unopened, and when ranges go."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from test_loads import FEB, FIRST, JAN, RANGES, Lost, dying, env  # noqa: F401

from tidemark.operators.keyranges import from_text, may_match, ranges_by_partition, to_text
from tidemark.operators.partitioning import DEFAULT, PART
from tidemark.plans import run as runs
from tidemark.sinks.table import AT, Table

BASE = [(1, "a", 10, "2024-01-05"), (2, "b", 20, "2024-01-20"), (11, "c", 30, "2024-02-03"), (12, "d", 40, "2024-02-09")]


def table(env):
    return Table(env.spark, env.name(), env.root)


def spoil(path):
    """Make the files of a directory unreadable; returns what puts them right."""
    files = list(Path(path.removeprefix("file:")).glob("*.parquet"))
    assert files
    kept = {f: f.read_bytes() for f in files}
    sums = {f: f.with_name(f".{f.name}.crc") for f in files}
    kept |= {c: c.read_bytes() for c in sums.values() if c.exists()}
    for f in files:
        f.write_bytes(b"no parquet")
        sums[f].unlink(missing_ok=True)
    return lambda: [f.write_bytes(b) for f, b in kept.items()]


@pytest.mark.parametrize("strategy", ["delta_upsert", "delete_insert"])
def test_new_keys_open_no_partition(env, strategy):
    spec = env.spec(strategy, partitioning=RANGES, analyze=False)
    env.run().load(spec, env.frame(*BASE))
    before = {label: table(env).location(label) for label in (JAN, FEB)}
    mend = [spoil(place) for place in before.values()]
    result = env.run().load(spec, env.frame((20, "e", 1, "2024-01-07"), (21, "e", 2, "2023-01-01")))
    for put_right in mend:
        put_right()
    env.spark.catalog.refreshTable(env.name())
    assert result.touched == {JAN, DEFAULT}
    assert {label: table(env).location(label) for label in (JAN, FEB)} == before
    assert env.parts() == [(JAN, 1, 10), (JAN, 2, 20), (JAN, 20, 1), (FEB, 11, 30), (FEB, 12, 40), (DEFAULT, 21, 2)]


def test_only_partitions_in_range_are_opened(env):
    spec = env.spec("delta_upsert", partitioning=RANGES, analyze=False)
    env.run().load(spec, env.frame(*BASE))
    mend = spoil(table(env).location(JAN))
    env.run().load(spec, env.frame((12, "d", 41, "2024-02-10")))
    mend()
    env.spark.catalog.refreshTable(env.name())
    assert env.parts() == [(JAN, 1, 10), (JAN, 2, 20), (FEB, 11, 30), (FEB, 12, 41)]


def test_added_rows_are_replaced_later_and_folded_in(env):
    spec = env.spec("delta_upsert", partitioning=RANGES)
    run = env.run(invocation_id="one")
    run.load(spec, env.frame(*BASE))
    run.load(spec, env.frame((30, "e", 1, "2024-01-07"), (30, "e", 2, "2024-01-08")))
    # Other rows under the same invocation are no repetition of those.
    run.load(spec, env.frame((40, "f", 3, "2024-01-09")))
    assert sum(AT in label for label in table(env).stored_labels()) == 2
    # The key moves to another partition; the batch it came in is written anew.
    env.run().load(spec, env.frame((30, "e", 5, "2024-02-07")))
    assert env.parts() == [(JAN, 1, 10), (JAN, 2, 20), (JAN, 40, 3), (FEB, 11, 30), (FEB, 12, 40), (FEB, 30, 5)]
    assert JAN in table(env).stored_labels() and not any(AT in s and s.startswith(JAN) for s in table(env).stored_labels())
    # The same delta again changes nothing.
    env.run().load(spec, env.frame((30, "e", 5, "2024-02-07")))
    assert len(env.parts()) == 6


def test_many_batches_are_folded(env, monkeypatch):
    monkeypatch.setattr(runs, "MOST_BATCHES", 2)
    spec = env.spec("delta_upsert", partitioning=RANGES, analyze=False)
    env.run().load(spec, env.frame(*BASE))
    counts = []
    for i in range(5):
        env.run().load(spec, env.frame((100 + i, "e", i, "2024-01-07")))
        counts.append(sum(AT in label for label in table(env).stored_labels()))
    assert counts == [1, 2, 0, 1, 2]
    assert [p[1] for p in env.parts() if p[0] == JAN] == [1, 2, 100, 101, 102, 103, 104]


def test_a_partition_of_batches_only_keeps_them(env):
    """`delta` adds batches without ranges; an upsert after it looks into them."""
    env.run().load(env.spec("delta", partitioning=RANGES), env.frame((1, "a", 10, "2024-01-05")))
    env.run().load(env.spec("delta", partitioning=RANGES), env.frame((2, "a", 20, "2024-02-05")))
    upsert = env.spec("delta_upsert", partitioning=RANGES)
    env.run().load(upsert, env.frame((2, "a", 21, "2024-02-06")))
    env.run().load(upsert, env.frame((3, "a", 30, "2024-02-07")))
    env.run().load(env.spec("delta", partitioning=RANGES), env.frame((4, "a", 40, "2024-01-07")))
    env.run().load(upsert, env.frame((4, "a", 41, "2024-01-08")))
    assert env.parts() == [(JAN, 1, 10), (JAN, 4, 41), (FEB, 2, 21), (FEB, 3, 30)]


def test_other_strategies_take_the_ranges_of_what_they_write_away(env):
    upsert = env.spec("delta_upsert", partitioning=RANGES)
    env.run().load(upsert, env.frame(*BASE))
    assert set(table(env).key_ranges()) == {JAN, FEB}
    env.run().load(env.spec("partitions", partitioning=RANGES), env.frame((50, "x", 1, "2024-01-06")))
    assert set(table(env).key_ranges()) == {FEB}
    env.run().load(upsert, env.frame((50, "x", 2, "2024-02-08")))
    assert (50, 2) in env.rows() and (50, 1) not in env.rows()
    table(env).forget_ranges()
    assert table(env).key_ranges() == {}


def test_null_keys(env):
    for match, left in ((True, [(None, 2)]), (False, [(None, 1), (None, 2)])):
        spec = env.spec("delta_upsert", partitioning=RANGES, null_keys_match=match)
        env.run(full_refresh=True).load(spec, env.frame((None, "a", 1, "2024-01-05")))
        env.run().load(spec, env.frame((None, "a", 2, "2024-01-06")))
        assert env.rows() == left


def test_refresh_keeps_ranges_right(env):
    spec = env.spec("delta_upsert", partitioning=RANGES)
    env.run().load(spec, env.frame(*BASE))
    env.run(full_refresh=True).load(spec, env.frame((99, "z", 9, "2024-01-05")))
    env.run().load(spec, env.frame((99, "z", 8, "2024-02-05")))
    assert env.parts() == [(FEB, 99, 8)]


@pytest.mark.parametrize("after", [0, 1])
def test_a_lost_upsert_is_finished_with_its_ranges(env, monkeypatch, after):
    kind = type(env.spark)
    monkeypatch.setattr(kind, "_plain_sql", kind.sql, raising=False)
    spec = env.spec("delta_upsert", partitioning=RANGES)
    env.run().load(spec, env.frame(*BASE))
    delta = env.frame((2, "b", 21, "2024-01-21"), (60, "g", 6, "2024-02-11"))
    with monkeypatch.context() as patch:
        patch.setattr(kind, "sql", dying(after))
        with pytest.raises(Lost):
            env.run().load(spec, delta)
    env.run().load(spec, env.frame((60, "g", 7, "2024-02-12")))
    assert env.rows() == [(1, 10), (2, 21), (11, 30), (12, 40), (60, 7)]


KINDS = {
    "long": [-5, 0, 7, 2**62],
    "decimal(12,2)": [Decimal("-1.50"), Decimal("-1.00"), Decimal("9.99"), Decimal("10.00")],
    "date": [date(1, 1, 1), date(1969, 12, 31), date(9999, 12, 31)],
    "timestamp": [datetime(1969, 12, 31, 23), datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1)],
    "timestamp_ntz": [datetime(1969, 12, 31, 23), datetime(2024, 1, 1)],
    "string": ["", "a", "a" * 40, "a" * 40 + "b", "é", "￿", "\U0001f600", "https://example.com/token"],
}


@pytest.mark.parametrize("kind", KINDS)
def test_equal_values_always_meet(spark, kind):
    values = KINDS[kind]
    rows = [(str(i), v) for i, v in enumerate(values)] + [("x", None)]
    found = ranges_by_partition(spark.createDataFrame(rows, f"{PART} string, k {kind}"), ["k"])
    everything = {"k": (min(r["k"][0] for r in found.values() if r["k"][0] is not None),
                        max(r["k"][1] for r in found.values() if r["k"][1] is not None), True)}
    for i, value in enumerate(values):
        own = from_text(to_text(found[str(i)]))
        assert may_match(own, found[str(i)]) and may_match(own, everything)
        assert not may_match(own, found["x"])
        others = [j for j in range(len(values)) if j != i and not may_match(own, found[str(j)])]
        assert others, "no other value told apart"
    assert may_match(found["x"], everything) and not may_match(found["x"], everything, False)


def test_keys_without_an_order_have_no_range(spark):
    df = spark.createDataFrame([("a", float("nan"), [1])], f"{PART} string, d double, l array<int>")
    assert ranges_by_partition(df, ["d", "l"]) == {}
    assert may_match({}, {"d": (1, 2, False)})


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1), st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1))
def test_ranges_that_do_not_meet_share_no_key(one, other):
    def ranges(rows):
        return {n: (min(r[i] for r in rows), max(r[i] for r in rows), False) for i, n in enumerate("ab")}

    if set(one) & set(other):
        assert may_match(ranges(one), ranges(other))
