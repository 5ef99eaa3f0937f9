"""Loads through tables and log: state after each run, re-runs, crashes."""

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import (
    ExpressionPartitions,
    Layout,
    ListPartitions,
    LoadLog,
    LoadRun,
    LoadSpec,
    RangePartitions,
)
from tidemark.operators.partitioning import DEFAULT, PART
from tidemark.plans.windows import next_window
from tidemark.sinks.table import Table

FIELDS = "id long, grp string, v long, dt timestamp_ntz"
RANGES = RangePartitions.of("dt", ("2024-01-01", "2024-03-01", "1 month"))


def at(text):
    return datetime.fromisoformat(text)


class Env:
    """A log and numbered runs in a fresh folder, with a settable clock."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.tag = f"t{uuid.uuid4().hex[:10]}"
        self.time = at("2024-06-01")
        self.log = LoadLog(spark, self.root, f"{self.tag}_log", clock=lambda: self.time)

    def run(self, **settings):
        self.time += timedelta(hours=1)
        return LoadRun(self.spark, self.root, self.log, **settings)

    def name(self, base="tab"):
        return f"{self.tag}_{base}"

    def spec(self, strategy, **settings):
        base = {"merge_keys": ["id"], "delta_field": "dt", "add_delta": False}
        return LoadSpec(self.name(), strategy, **{**base, **settings})

    def frame(self, *rows):
        data = [(i, g, v, at(d) if d else None) for i, g, v, d in rows]
        return self.spark.createDataFrame(data, FIELDS)

    def rows(self, table=None):
        df = (table or Table(self.spark, self.name(), self.root)).read()
        return sorted((r.id, r.v) for r in df.collect())

    def parts(self):
        df = Table(self.spark, self.name(), self.root).read_parts()
        return sorted((r[PART], r.id, r.v) for r in df.collect())

    def logged(self):
        df = self.log.entries().filter(F.col("object_name") == self.name())
        return df.orderBy("created_at", "load_type").collect()


@pytest.fixture
def env(spark, tmp_path):
    return Env(spark, tmp_path)


JAN, FEB, MAR = "2024-01-01", "2024-02-01", "2024-03-01"
FIRST = [(1, "a", 10, "2024-01-05"), (2, "a", 20, "2024-01-20"), (3, "b", 30, "2024-02-03")]
SECOND = [(2, "a", 21, "2024-01-20"), (4, "b", 40, "2024-02-10")]


def test_init_logs_count_and_mark(env):
    env.run().load(env.spec("delta_upsert"), env.frame(*FIRST))
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]
    (row,) = env.logged()
    assert (row.status, row.load_type, row.row_cnt) == (2, "init", 3)
    assert row.extraction_to == at("2024-02-03")


def test_upsert_is_idempotent_and_gates_on_empty_delta(env):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    for _ in range(2):
        env.run().load(spec, env.frame(*SECOND))
        assert env.rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]
    location = Table(env.spark, spec.name, env.root).location()
    result = env.run().load(spec, env.frame())
    assert result.row_cnt == 0
    assert Table(env.spark, spec.name, env.root).location() == location
    last = env.logged()[-1]
    assert last.status == 2 and last.row_cnt == 0 and last.extraction_to is None
    assert env.log.last_extraction(spec.name) == at("2024-02-10")


def test_upsert_of_new_keys_inserts_without_rewriting(env):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    table = Table(env.spark, spec.name, env.root)
    location = table.location()
    env.run().load(spec, env.frame((8, "c", 80, MAR), (9, "c", 90, MAR)))
    assert env.rows() == [(1, 10), (2, 20), (3, 30), (8, 80), (9, 90)]
    assert table.location() == location
    env.run().load(spec, env.frame((9, "c", 91, MAR)))
    assert env.rows()[-1] == (9, 91)
    assert table.location() != location


def test_new_partitions_are_taken_as_staged(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    writes = []
    original = Table.write

    def write(self, *args, **kwargs):
        writes.append(self.name)
        return original(self, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Table, "write", write)
        result = env.run().load(spec, env.frame((8, "c", 80, MAR), (9, "c", 90, "2024-04-01")))
        assert writes.count(spec.name) == 1
        env.run().load(spec, env.frame((8, "c", 81, MAR), (7, "c", 70, "2024-05-01")))
        assert writes.count(spec.name) == 3
    assert result.touched == {"2024-03-01", "2024-04-01"}
    assert env.parts()[3:] == [
        ("2024-03-01", 8, 81),
        ("2024-04-01", 9, 90),
        ("2024-05-01", 7, 70),
    ]


def test_upsert_null_keys(env):
    both = [(None, "a", 1, JAN), (1, "a", 2, JAN)]
    for match, expected in ((True, [1, 2]), (False, [1, 1, 2])):
        other = Env(env.spark, f"{env.root}/{match}")
        spec = other.spec("delta_upsert", null_keys_match=match)
        other.run().load(spec, other.frame(*both))
        other.run().load(spec, other.frame(*both))
        table = Table(other.spark, spec.name, other.root)
        assert sorted(r.v for r in table.read().collect()) == expected


def test_upsert_deletes_duplicates_of_the_delta(env):
    spec = env.spec("delta_upsert", delete_duplicates=True)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame((2, "a", 5, "2024-03-01"), (2, "a", 6, "2024-03-02")))
    assert env.rows() == [(1, 10), (2, 6), (3, 30)]


def test_full_keeps_backup_and_accepts_empty_source(env):
    spec = env.spec("full")
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    table = Table(env.spark, spec.name, env.root)
    assert env.rows() == [(2, 21), (4, 40)]
    assert env.rows(table.backup()) == [(1, 10), (2, 20), (3, 30)]
    env.run().load(spec, env.frame())
    assert env.rows() == []
    assert env.rows(table.backup()) == [(2, 21), (4, 40)]
    row = env.logged()[-1]
    assert (row.load_type, row.status, row.row_cnt) == ("full", 2, 0)
    assert row.extraction_to == env.time


def test_full_without_backup(env):
    spec = env.spec("full", keep_backup=False)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    assert not Table(env.spark, spec.name, env.root).backup().exists()


def test_full_on_partitions_with_backup(env):
    spec = env.spec("full", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame((9, "z", 9, "2024-02-01")))
    assert env.parts() == [(FEB, 9, 9)]
    backup = Table(env.spark, spec.name, env.root).backup()
    assert env.rows(backup) == [(1, 10), (2, 20), (3, 30)]


def test_full_adds_its_own_entry_beside_an_open_window(env):
    spec = env.spec("full", add_delta=True)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*FIRST))
    assert [(r.status, r.load_type) for r in env.logged()] == [
        (2, "init"),
        (1, None),
        (2, "full"),
    ]


def test_merge_keeps_ties_or_one_row(env):
    spec = env.spec("delta_merge")
    env.run().load(spec, env.frame(*FIRST, (1, "a", 11, "2024-01-06")))
    env.run().load(spec, env.frame((2, "a", 5, JAN), (2, "a", 6, FEB)))
    assert env.rows() == [(1, 10), (1, 11), (2, 5), (2, 6), (3, 30)]
    backup = Table(env.spark, spec.name, env.root).backup()
    assert env.rows(backup) == [(1, 10), (1, 11), (2, 20), (3, 30)]
    single = env.spec("delta_merge", delete_duplicates=True)
    env.run().load(single, env.frame((3, "b", 31, FEB)))
    assert env.rows() == [(1, 11), (2, 6), (3, 31)]


def test_merge_on_default_partition_only(env):
    spec = env.spec("delta_merge", partitioning=RangePartitions("id"))
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    assert env.parts() == [(DEFAULT, i, v) for i, v in [(1, 10), (2, 21), (3, 30), (4, 40)]]


def test_delta_appends_the_boundary_row_again_unless_excluded(env):
    source = env.frame(*FIRST)
    spec = env.spec("delta", partitioning=RANGES, add_delta=True)
    env.run().load(spec, source)
    env.run().load(spec, source)
    assert env.rows() == [(1, 10), (2, 20), (3, 30), (3, 30)]
    env.run().load(
        env.spec("delta", partitioning=RANGES, add_delta=True, lower_exclusive=True), source
    )
    assert env.rows() == [(1, 10), (2, 20), (3, 30), (3, 30)]


def test_delta_adds_partitions_and_splits_default(env):
    spec = env.spec("delta", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST, (5, "c", 50, "2024-04-02"), (6, "c", 60, "2023-01-01")))
    assert (DEFAULT, 5, 50) in env.parts()
    env.run().load(spec, env.frame((7, "c", 70, "2024-05-01")))
    assert env.parts() == [
        ("2024-01-01", 1, 10),
        ("2024-01-01", 2, 20),
        ("2024-02-01", 3, 30),
        ("2024-04-01", 5, 50),
        ("2024-05-01", 7, 70),
        (DEFAULT, 6, 60),
    ]
    names = [p.name for p in Table(env.spark, spec.name, env.root).partitioning().ranges()]
    assert names == ["m_01_2024", "m_02_2024", "m_03_2024", "m_04_2024", "m_05_2024"]


def test_partitions_merge_inside_a_partition_leaves_moved_key(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    before = Table(env.spark, spec.name, env.root).location(FEB)
    result = env.run().load(spec, env.frame((2, "a", 22, "2024-01-02"), (3, "b", 33, "2024-01-09")))
    assert env.parts() == [(JAN, 1, 10), (JAN, 2, 22), (JAN, 3, 33), (FEB, 3, 30)]
    assert result.touched == {JAN}
    assert Table(env.spark, spec.name, env.root).location(FEB) == before


def test_partitions_merge_across_partitions_empties_a_partition(env):
    spec = env.spec(
        "partitions", partitioning=ExpressionPartitions.monthly("dt"), dedup_scope="changed"
    )
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame((3, "b", 33, "2024-01-09"), (3, "b", 31, "2024-02-01")))
    assert env.parts() == [("202401", 1, 10), ("202401", 2, 20), ("202402", 3, 31)]
    env.run().load(spec, env.frame((3, "b", 34, "2024-03-09"), (3, "b", 32, "2024-02-02")))
    assert env.parts() == [("202401", 1, 10), ("202401", 2, 20), ("202403", 3, 34)]
    assert Table(env.spark, spec.name, env.root).labels() == {"202401", "202403"}


def test_emptied_partition_does_not_come_back(env):
    spec = env.spec(
        "partitions", partitioning=ExpressionPartitions.monthly("dt"), dedup_scope="changed"
    )
    env.run().load(spec, env.frame((3, "b", 30, "2024-02-03")))
    env.run().load(spec, env.frame((3, "b", 31, "2024-03-01"), (3, "b", 31, "2024-02-01")))
    assert env.parts() == [("202403", 3, 31)]
    env.run().load(env.spec("append"), env.frame((8, "b", 80, "2024-02-20")))
    assert env.parts() == [("202402", 8, 80), ("202403", 3, 31)]


@pytest.mark.parametrize("merge", [True, False])
def test_unrouted_rows(env, merge):
    old = (6, "c", 60, "2023-01-01")
    spec = env.spec("partitions", partitioning=RANGES, merge_partitions=merge)
    env.run().load(spec, env.frame(*FIRST, (5, "c", 50, "2023-05-05")))
    env.run().load(env.spec(**_as_args(spec, unrouted="drop")), env.frame(old, (1, "a", 9, JAN)))
    assert (DEFAULT, 6, 60) not in env.parts()
    with pytest.raises(ValueError, match="outside every partition"):
        env.run().load(env.spec(**_as_args(spec, unrouted="error")), env.frame(old))
    env.run().load(spec, env.frame(old, (7, "c", 70, None)))
    default = [p for p in env.parts() if p[0] == DEFAULT]
    assert default == [(DEFAULT, 5, 50), (DEFAULT, 6, 60), (DEFAULT, 7, 70)]
    kept = [p for p in env.parts() if p[0] == JAN]
    assert kept == ([(JAN, 1, 9), (JAN, 2, 20)] if merge else [(JAN, 1, 9)])


def test_unrouted_rows_and_extra_columns_are_reported(env, caplog):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    delta = env.frame((6, "c", 60, "2023-01-01"), (7, "c", 70, None), (1, "a", 11, "2024-01-05"))
    result = env.run().load(spec, delta.withColumn("more", F.lit(1)))
    assert result.unrouted == 2
    assert "2 delta rows outside every named partition" in caplog.text
    assert "left out: more" in caplog.text


def test_default_partition_only_with_a_number_key(env):
    spec = env.spec("partitions", partitioning=RangePartitions("id"))
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    assert env.rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]
    env.run().load(env.spec("delta", partitioning=RangePartitions("id")), env.frame(SECOND[0]))
    assert env.rows() == [(1, 10), (2, 21), (2, 21), (3, 30), (4, 40)]


def test_zoned_timestamps_mark_in_the_session_zone(env):
    spec = env.spec("delta_upsert", add_delta=True)
    zoned = env.frame(*FIRST).withColumn("dt", F.col("dt").cast("timestamp"))
    env.run().load(spec, zoned)
    assert env.log.last_extraction(spec.name) == at("2024-02-03")
    env.run().load(spec, zoned.withColumn("v", F.lit(7).cast("long")))
    assert env.rows() == [(1, 10), (2, 20), (3, 7)]


def test_merge_reads_only_the_touched_partitions(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    plans = []
    original = Table.write

    def write(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return original(self, df, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Table, "write", write)
        env.run().load(spec, env.frame((2, "a", 22, "2024-01-02")))
    merge = plans[-1]
    assert "BroadcastHashJoin" in merge
    assert f"PartitionFilters: [isnotnull({PART}" in merge and f"({PART}" in merge
    assert "2024-01-01" in merge and "2024-02-01" not in merge
    assert "Exchange hashpartitioning" not in merge.split("BroadcastExchange")[0]


def _as_args(spec, **changes):
    names = ("strategy", "partitioning", "merge_partitions", "delete_duplicates")
    return {**{n: getattr(spec, n) for n in names}, **changes}


def test_partitions_overwrite_leaves_others_and_dedups(env):
    spec = env.spec(
        "partitions", partitioning=RANGES, merge_partitions=False, delete_duplicates=True
    )
    env.run().load(spec, env.frame(*FIRST))
    row = (9, "x", 90, "2024-02-15")
    result = env.run().load(spec, env.frame(row, row))
    assert env.parts() == [(JAN, 1, 10), (JAN, 2, 20), (FEB, 9, 90)]
    assert result.row_cnt == 2


def test_overwrite_replaces_rows_that_a_split_moved(env):
    spec = env.spec("partitions", partitioning=RANGES, merge_partitions=False)
    env.run().load(
        spec, env.frame(*FIRST, (5, "c", 50, "2024-03-02"), (6, "c", 60, "2024-04-02"))
    )
    env.run().load(spec, env.frame((7, "c", 70, "2024-04-20")))
    assert env.parts()[-2:] == [("2024-03-01", 5, 50), ("2024-04-01", 7, 70)]


def test_merge_after_split_compares_with_moved_rows(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST, (5, "c", 50, "2024-03-02"), (6, "c", 60, "2024-04-02")))
    env.run().load(spec, env.frame((6, "c", 61, "2024-04-20")))
    assert env.parts()[-2:] == [("2024-03-01", 5, 50), ("2024-04-01", 6, 61)]


def test_row_number_merge_dedups_every_overlapped_partition(env):
    spec = env.spec("partitions", partitioning=RANGES, delete_duplicates=True)
    env.run().load(spec, env.frame(*FIRST, (3, "b", 31, "2024-02-04")))
    env.run().load(spec, env.frame((8, "c", 80, "2024-01-31")))
    assert [p for p in env.parts() if p[0] == FEB] == [(FEB, 3, 30), (FEB, 3, 31)]
    env.run().load(spec, env.frame((8, "c", 81, "2024-01-31"), (9, "c", 90, "2024-03-01")))
    assert [p for p in env.parts() if p[0] == FEB] == [(FEB, 3, 31)]


def test_upsert_on_partitions_rewrites_only_what_it_must(env):
    spec = env.spec("delta_upsert", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST, (5, "c", 50, "2023-01-01")))
    table = Table(env.spark, spec.name, env.root)
    untouched = table.location(DEFAULT)
    result = env.run().load(spec, env.frame((3, "b", 33, "2024-01-09")))
    assert env.parts() == [(JAN, 1, 10), (JAN, 2, 20), (JAN, 3, 33), (DEFAULT, 5, 50)]
    assert result.touched == {JAN, FEB}
    assert table.location(DEFAULT) == untouched


def test_list_partitions(env):
    spec = env.spec("partitions", partitioning=ListPartitions("grp", ("a", "b c/d")))
    env.run().load(spec, env.frame((1, "a", 1, JAN), (2, "b c/d", 2, JAN), (3, "z", 3, JAN)))
    env.run().load(spec, env.frame((2, "b c/d", 22, JAN), (4, "q", 4, JAN)))
    assert env.parts() == [(DEFAULT, 3, 3), (DEFAULT, 4, 4), ("a", 1, 1), ("b+c~2Fd", 2, 22)]


def test_plain_strategies_write_no_log(env):
    env.run().load(env.spec("append"), env.frame(*FIRST))
    env.run().load(env.spec("append"), env.frame(FIRST[0]))
    assert env.rows() == [(1, 10), (1, 10), (2, 20), (3, 30)]
    env.run().load(env.spec("delete_insert"), env.frame((1, "a", 12, JAN)))
    assert env.rows() == [(1, 12), (2, 20), (3, 30)]
    env.run().load(env.spec("truncate_insert"), env.frame((7, "a", 7, JAN)))
    assert env.rows() == [(7, 7)]
    assert env.logged() == []


def test_auto_filter_takes_the_window_from_the_log(env):
    spec = env.spec("delta_upsert", add_delta=True, safety_period="10 days")
    env.run().load(spec, env.frame(*FIRST))
    changed = env.frame((2, "a", 99, "2024-01-20"), (3, "b", 99, "2024-01-25"))
    env.run().load(spec, changed)
    assert env.rows() == [(1, 10), (2, 20), (3, 99)]
    last = env.logged()[-1]
    assert last.extraction_from_original == at("2024-01-24")
    assert last.extraction_to == at("2024-01-25")


def test_user_dates_win(env):
    spec = env.spec("delta_upsert", add_delta=True)
    env.run().load(spec, env.frame(*FIRST))
    run = env.run(start_date="2024-01-01", end_date="2024-01-10T00:00:00")
    run.load(spec, env.frame((1, "a", 99, "2024-01-05"), (2, "a", 99, "2024-01-20")))
    assert env.rows() == [(1, 99), (2, 20), (3, 30)]


def test_explicit_filter(env):
    spec = env.spec("delta_upsert")
    run = env.run()
    assert run.filter_delta(env.frame(*FIRST), spec, "dt", True).count() == 3
    run.load(spec, env.frame(*FIRST))
    run = env.run()
    assert run.filter_delta(env.frame(*FIRST), spec).count() == 3
    assert run.filter_delta(env.frame(*FIRST), spec, "dt", log_dates=True).count() == 1
    assert run.filter_delta(env.frame(*FIRST), spec).count() == 1
    with pytest.raises(ValueError):
        run.filter_delta(env.frame(*FIRST), spec, log_dates=True)
    assert env.run(full_refresh=True).filter_delta(env.frame(*FIRST), spec, "dt", True).count() == 3


def test_full_refresh_rebuilds_and_resets_partitions(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame((9, "z", 9, "2024-04-04")))
    env.run(full_refresh=True).load(spec, env.frame(*SECOND))
    assert env.parts() == [(JAN, 2, 21), (FEB, 4, 40)]
    assert Table(env.spark, spec.name, env.root).partitioning() == RANGES
    assert env.logged()[-1].load_type == "init"


def test_full_refresh_takes_a_new_structure(env):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    env.run(full_refresh=True).load(spec, env.frame(*FIRST).withColumn("extra", F.lit(1)))
    assert "extra" in Table(env.spark, spec.name, env.root).read().columns


def test_view_is_replaced_by_table(env):
    env.frame(*FIRST).createOrReplaceTempView(env.name())
    env.run().load(env.spec("delta_upsert"), env.frame(*SECOND))
    assert env.rows() == [(2, 21), (4, 40)]
    assert not Table(env.spark, env.name(), env.root).is_view()


def test_declared_fields_and_layout(env):
    spec = env.spec(
        "delta_upsert",
        fields="id int8, grp varchar(1) NULL, v numeric(10,2), dt date",
        layout=Layout(("id",), ("v",), "zstd", 3),
    )
    env.run().load(spec, env.frame((1, "abc", 1, "2024-01-05T10:00:00")))
    table = Table(env.spark, spec.name, env.root)
    assert table.schema().simpleString() == (
        "struct<id:bigint,grp:string,v:decimal(10,2),dt:date>"
    )
    assert table.read().first().grp == "a"
    env.run().load(spec, env.frame((2, "b", 2, "2024-01-06")))
    assert table.read().count() == 2


def test_missing_column_fails_and_extra_is_left_out(env):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    with pytest.raises(ValueError, match="lacks target columns: grp"):
        env.run().load(spec, env.frame(*FIRST).drop("grp"))
    env.run().load(spec, env.frame(*SECOND).withColumn("more", F.lit(1)))
    assert env.rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]


def test_hooks_and_sql_models(env):
    calls = []
    spec = env.spec(
        "delta_upsert",
        pre_hooks=[lambda s: calls.append("pre")],
        post_hooks=[lambda s: calls.append("post")],
    )
    env.frame(*FIRST).createOrReplaceTempView(f"{env.tag}_src")
    text = f"SELECT * FROM {env.tag}_src WHERE id > 1"
    env.run().load(spec, text)
    assert calls == ["pre", "post"]
    assert env.rows() == [(2, 20), (3, 30)]
    assert env.logged()[0].model_sql == text


@pytest.mark.parametrize("partitioning", [None, RANGES])
def test_crash_before_the_switch_keeps_the_old_version(env, monkeypatch, partitioning):
    strategy = "partitions" if partitioning else "delta_upsert"
    spec = env.spec(strategy, partitioning=partitioning)
    env.run().load(spec, env.frame(*FIRST))
    with monkeypatch.context() as patch:

        def fail(*args, **kwargs):
            raise RuntimeError("lost")

        patch.setattr(Table, "point_to", fail)
        patch.setattr(Table, "switch_partitions", fail)
        with pytest.raises(RuntimeError):
            env.run().load(spec, env.frame(*SECOND))
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]
    env.run().load(spec, env.frame(*SECOND))
    assert env.rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]


def test_failing_task_leaves_the_table_alone(env):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    bad = env.frame(*SECOND).withColumn("v", F.expr("CAST(raise_error('boom') AS long)"))
    with pytest.raises(Exception, match="boom"):
        env.run().load(spec, bad)
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]


def test_vacuum_removes_unused_versions_only(env):
    spec = env.spec("full")
    table = Table(env.spark, spec.name, env.root)
    for i in range(4):
        env.run().load(spec, env.frame((i, "a", i, JAN)))
    assert len(table.vacuum()) == 2
    assert env.rows() == [(3, 3)] and env.rows(table.backup()) == [(2, 2)]
    assert table.vacuum() == []


def test_vacuum_of_partitions(env):
    spec = env.spec("partitions", partitioning=RANGES)
    table = Table(env.spark, spec.name, env.root)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    env.run().load(spec, env.frame((2, "a", 23, "2024-01-20")))
    before = env.parts()
    assert table.vacuum()
    assert env.parts() == before == [(JAN, 1, 10), (JAN, 2, 23), (FEB, 3, 30), (FEB, 4, 40)]


def test_analyze_columns(env):
    spec = env.spec("delta_upsert", analyze="columns")
    env.run().load(spec, env.frame(*FIRST))
    stats = env.spark.sql(f"DESCRIBE EXTENDED {spec.name}").filter("col_name = 'Statistics'")
    assert "3 rows" in stats.first()["data_type"]


def _statistics(spark, name, part=""):
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {part}").collect()
    return [r.data_type for r in rows if r.col_name in ("Statistics", "Partition Statistics")]


def test_statistics_follow_the_loads(env):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    assert "3 rows" in _statistics(env.spark, spec.name)[0]
    env.run().load(spec, env.frame(*SECOND))
    assert "4 rows" in _statistics(env.spark, spec.name)[0]


def test_a_grown_partitioned_table_does_not_look_small(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame((1, "a", 11, "2024-01-05")))
    assert _statistics(env.spark, spec.name) == []
    part = f"PARTITION ({PART} = '{JAN}')"
    assert "2 rows" in _statistics(env.spark, spec.name, part)[0]
    size = Table(env.spark, spec.name, env.root).read_parts()
    assert size._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 10**12


@pytest.mark.parametrize(
    "settings",
    [
        {"strategy": "merge"},
        {"strategy": "delta_upsert", "merge_keys": []},
        {"strategy": "delta_merge", "merge_keys": []},
        {"strategy": "delta_upsert", "delta_field": None},
        {"strategy": "partitions"},
        {"strategy": "delta"},
        {"strategy": "full", "unrouted": "lose"},
        {"strategy": "full", "dedup_scope": "all"},
        {"strategy": "full", "fields": "id whatever"},
    ],
)
def test_invalid_specs(env, settings):
    with pytest.raises(ValueError):
        env.spec(**settings).validate()


def test_merge_keys_default():
    assert LoadSpec("t", "full").keys == ["id"]


# -- marks, unrouted rows --------------------------------------------------------------


OPEN_ROW = (7, "open", 70, "9999-12-31")


@pytest.mark.parametrize("strategy", ["delta_upsert", "partitions", "delta"])
def test_open_rows_are_no_mark(env, strategy):
    parts = None if strategy == "delta_upsert" else RANGES
    spec = env.spec(strategy, partitioning=parts, add_delta=True)
    env.run().load(spec, env.frame(*FIRST, OPEN_ROW))
    assert env.log.last_extraction(spec.name) == at("2024-02-03")
    env.run().load(spec, env.frame((8, "c", 80, "2024-02-20"), (9, "old", 90, "2024-01-01")))
    assert (8, 80) in env.rows() and (9, 90) not in env.rows() and (7, 70) in env.rows()
    assert env.log.last_extraction(spec.name) == at("2024-02-20")


def test_rows_ahead_of_the_clock_do_not_move_the_mark_beyond_the_window(env, caplog):
    spec = env.spec("delta_upsert", add_delta=True)
    env.run().load(spec, env.frame(*FIRST, (5, "z", 50, "2031-01-01")))
    assert env.log.last_extraction(spec.name) == env.time
    env.time = at("2024-06-05")
    env.run().load(spec, env.frame((8, "c", 80, "2024-06-02")))
    assert (8, 80) in env.rows()
    env.time = at("2024-01-01")
    env.run().load(spec, env.frame((9, "c", 90, "2024-06-03")))
    assert "is empty" in caplog.text


def test_a_mark_at_the_end_of_time_in_an_older_log_is_passed_over(env):
    env.run().load(env.spec("delta_upsert", add_delta=True), env.frame(*FIRST))
    env.log.complete("older", env.name(), "delta_upsert", 1, at("9999-12-31"), "dt")
    assert env.log.last_extraction(env.name()) == at("2024-02-03")


STRAY = (6, "c", 60, "2023-01-01")
PARTED = ["partitions", "delta", "delta_upsert", "delta_merge", "full", "append", "delete_insert", "truncate_insert"]


@pytest.mark.parametrize("strategy", PARTED)
def test_unrouted_rows_in_every_partitioned_load(env, strategy, caplog):
    def spec(unrouted):
        return env.spec(strategy, partitioning=RANGES, unrouted=unrouted)

    with pytest.raises(ValueError, match="1 delta rows outside every partition"):
        env.run().load(spec("error"), env.frame(*FIRST, STRAY))
    table = Table(env.spark, env.name(), env.root)
    assert not table.exists()
    result = env.run().load(spec("drop"), env.frame(*FIRST, STRAY))
    assert (result.row_cnt, result.unrouted) == (3, 1)
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]
    before = env.parts()
    with pytest.raises(ValueError, match="outside every partition"):
        env.run().load(spec("error"), env.frame(SECOND[1], STRAY))
    assert env.parts() == before
    result = env.run().load(spec("drop"), env.frame(SECOND[1], STRAY))
    assert result.unrouted == 1 and (6, 60) not in env.rows() and (4, 40) in env.rows()
    result = env.run().load(spec("default"), env.frame(STRAY))
    assert result.unrouted == 1 and (DEFAULT, 6, 60) in env.parts()
    assert "outside every named partition" in caplog.text


def test_init_logs_unrouted_rows(env):
    env.run().load(env.spec("partitions", partitioning=RANGES), env.frame(*FIRST, STRAY))
    (row,) = env.logged()
    assert (row.row_cnt, row.unrouted) == (4, 1)


# -- batches -----------------------------------------------------------------------------


MORE = [(4, "b", 40, "2024-02-10"), (5, "c", 50, "2024-04-02"), (6, "c", 60, "2023-05-05")]


@pytest.mark.parametrize("strategy", ["delta", "append"])
def test_appending_again_in_one_invocation_adds_nothing(env, strategy):
    spec = env.spec(strategy, partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST, (9, "d", 90, "2024-04-01")))
    env.run(invocation_id="second").load(spec, env.frame(*MORE))
    once = env.parts()
    assert len(once) == 7
    env.run(invocation_id="second").load(spec, env.frame(*MORE))
    assert env.parts() == once
    env.run(invocation_id="third").load(spec, env.frame(MORE[0]))
    assert [p for p in env.parts() if p[1] == 4] == [(FEB, 4, 40)] * 2
    # A batch that comes with fewer partitions leaves none of the first behind.
    env.run(invocation_id="third").load(spec, env.frame((1, "a", 11, JAN)))
    assert [p for p in env.parts() if p[1] == 4] == [(FEB, 4, 40)]


def test_a_repeated_run_reads_the_window_that_it_had(env):
    spec = env.spec("delta", partitioning=RANGES, add_delta=True)
    env.run().load(spec, env.frame(*FIRST))
    source = env.frame(*FIRST, (4, "b", 40, "2024-02-10"))
    for _ in range(2):
        result = env.run(invocation_id="again").load(spec, source)
        assert result.row_cnt == 2 and env.rows() == [(1, 10), (2, 20), (3, 30), (3, 30), (4, 40)]


def test_append_without_partitions_by_batches(env):
    spec = env.spec("append")
    table = Table(env.spark, spec.name, env.root)
    env.run().load(spec, env.frame(*FIRST))
    for _ in range(2):
        env.run(invocation_id="x").load(spec, env.frame(SECOND[1]))
    assert env.rows() == [(1, 10), (2, 20), (3, 30), (4, 40)]
    assert table.read().columns == ["id", "grp", "v", "dt"]
    env.run().load(env.spec("delta_upsert"), env.frame((4, "b", 41, FEB)))
    assert env.rows() == [(1, 10), (2, 20), (3, 30), (4, 41)]
    env.run().load(spec, env.frame((5, "b", 50, FEB)))
    env.run().load(env.spec("full"), env.frame(*SECOND))
    assert env.rows() == [(2, 21), (4, 40)]
    assert env.rows(table.backup()) == [(1, 10), (2, 20), (3, 30), (4, 41), (5, 50)]
    table.vacuum()
    assert env.rows() == [(2, 21), (4, 40)] and len(env.rows(table.backup())) == 5


def test_merge_folds_batches_in(env):
    spec = env.spec("delta", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    for i in range(3):
        env.run().load(spec, env.frame((10 + i, "b", i, "2024-02-10"), (20 + i, "a", i, JAN)))
    table = Table(env.spark, spec.name, env.root)
    assert len(table.stored_labels()) == 8 and table.labels() == {JAN, FEB}
    plans = []
    original = Table.write

    def write(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return original(self, df, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Table, "write", write)
        env.run().load(env.spec("partitions", partitioning=RANGES), env.frame((11, "b", 99, "2024-02-01")))
    assert "PartitionFilters: [" in plans[-1] and "substring_index" in plans[-1].split("PartitionFilters")[1]
    assert {s for s in table.stored_labels() if s.startswith(FEB)} == {FEB}
    assert [p for p in env.parts() if p[0] == FEB] == [(FEB, 3, 30), (FEB, 10, 0), (FEB, 11, 99), (FEB, 12, 2)]
    assert len([p for p in env.parts() if p[0] == JAN]) == 5


class Lost(Exception):
    pass


def dying(after):
    """A session that is lost after some statements that change partitions."""
    said = []

    def sql(self, query, *args, **kwargs):
        if "_part" in query and ("ADD" in query or "DROP" in query or "SET LOCATION" in query):
            if len(said) == after:
                raise Lost
            said.append(query)
        return type(self)._plain_sql(self, query, *args, **kwargs)

    return sql


@pytest.fixture
def lose(env, monkeypatch):
    kind = type(env.spark)
    monkeypatch.setattr(kind, "_plain_sql", kind.sql, raising=False)

    def load(after, run, spec, df):
        with monkeypatch.context() as patch:
            patch.setattr(kind, "sql", dying(after))
            with pytest.raises(Lost):
                run.load(spec, df)

    return load


@pytest.mark.parametrize("after", [0, 1])
def test_a_lost_append_is_finished_and_logged_by_the_next_run(env, lose, after):
    spec = env.spec("delta", partitioning=RANGES, add_delta=True)
    env.run().load(spec, env.frame(*FIRST, (5, "c", 50, "2024-04-02")))
    env.log.clear(spec.name, "2025-01-01")
    source = env.frame((7, "c", 70, "2024-04-09"), (8, "d", 80, "2024-05-09"))
    # Two statements: the row that waited in the default partition, and the batch.
    lose(after, env.run(invocation_id="lost"), spec, source)
    env.run().load(spec, env.frame((9, "d", 90, "2024-05-10")))
    rows = [(1, 10), (2, 20), (3, 30), (5, 50), (7, 70), (8, 80), (9, 90)]
    assert env.rows() == rows
    done = [r for r in env.logged() if r.invocation_id == "lost"]
    assert [(r.status, r.row_cnt, r.extraction_to) for r in done] == [(2, 2, at("2024-05-09"))]
    assert env.logged()[-1].extraction_from_original == at("2024-05-09")
    names = [p.name for p in Table(env.spark, spec.name, env.root).partitioning().ranges()]
    assert names[-1] == "m_05_2024"


def test_append_lost_before_the_switch_leaves_no_rows(env, monkeypatch):
    spec = env.spec("delta", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    before = env.parts()
    with monkeypatch.context() as patch:
        patch.setattr(Table, "switch", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            env.run(invocation_id="x").load(spec, env.frame(*MORE))
    assert env.parts() == before
    env.run(invocation_id="x").load(spec, env.frame(*MORE))
    assert len(env.parts()) == len(before) + len(MORE)


@pytest.mark.parametrize("after", [1, 3, 5])
def test_half_a_switch_is_finished_by_the_next_load(env, lose, after):
    spec = env.spec("partitions", partitioning=ExpressionPartitions("grp", "grp"), dedup_scope="changed")
    first = [(i, f"g{i}", i, JAN) for i in range(5)]
    env.run().load(spec, env.frame(*first))
    delta = [(i, f"g{i}", -i - 1, JAN) for i in range(4)] + [(0, "g9", 7, JAN), (4, "g4", 7, JAN)]
    lose(after, env.run(), spec, env.frame(*delta))
    table = Table(env.spark, spec.name, env.root)
    assert table.unfinished() is not None
    result = env.run().load(spec, env.frame())
    assert result.row_cnt == 0 and table.unfinished() is None
    want = {(i, f"g{i}") for i in range(1, 5)}
    got = {(r.id, r.grp): r.v for r in table.read().collect()}
    assert want <= got.keys() and len(got) == 5
    assert all(got[i, f"g{i}"] == -i - 1 for i in range(1, 4))


def test_a_journal_cut_short_is_passed_over(env):
    spec = env.spec("partitions", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    table = Table(env.spark, spec.name, env.root)
    files, path = table._journal()
    out = files.create(path, True)
    out.write(bytearray(b'{"places": {"2024-01'))
    out.close()
    env.run().load(spec, env.frame(*SECOND))
    assert env.rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]


# -- refresh by rename -------------------------------------------------------------------


def test_a_failing_create_leaves_the_old_table(env, monkeypatch):
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    env.spark.sql(f"ALTER TABLE {spec.name} SET TBLPROPERTIES ('owner.team' = 'blue')")
    wider = env.frame(*SECOND).withColumn("extra", F.lit(1))
    with monkeypatch.context() as patch:
        patch.setattr(Table, "create", lambda *a, **k: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            env.run(full_refresh=True).load(spec, wider)
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]
    env.run(full_refresh=True).load(spec, wider)
    table = Table(env.spark, spec.name, env.root)
    assert env.rows() == [(2, 21), (4, 40)] and table.read().columns[-1] == "extra"
    assert table.properties()["owner.team"] == "blue"
    assert not table.beside("stg").exists()


@pytest.mark.parametrize("after", [0, 1])
def test_renames_lost_half_way_are_finished(env, monkeypatch, after):
    spec = env.spec("full", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    kind, said = type(env.spark), []
    plain = kind.sql

    def sql(self, query, *args, **kwargs):
        if "RENAME" in query:
            if len(said) == after:
                raise Lost
            said.append(query)
        return plain(self, query, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(kind, "sql", sql)
        with pytest.raises(Lost):
            env.run().load(spec, env.frame(*SECOND))
    table = Table(env.spark, spec.name, env.root)
    assert table.exists() == (after == 0)
    env.run().load(env.spec("partitions", partitioning=RANGES), env.frame())
    assert env.rows() == [(2, 21), (4, 40)]
    assert env.rows(table.backup()) == [(1, 10), (2, 20), (3, 30)]
    assert table.partitioning() == RANGES


def test_statistics_cost_follows_the_change(env, monkeypatch):
    spec = env.spec("partitions", partitioning=ExpressionPartitions("grp", "grp"))
    env.run().load(spec, env.frame(*[(i, f"g{i:02}", i, JAN) for i in range(20)]))
    said = []
    sql = type(env.spark).sql
    monkeypatch.setattr(type(env.spark), "sql", lambda self, q, *a, **k: said.append(q) or sql(self, q, *a, **k))
    env.run().load(spec, env.frame(*[(i, f"g{i:02}", -i, JAN) for i in range(5)]))
    asked = [q for q in said if "ANALYZE" in q]
    assert len(asked) == 5 and all(f"g{i:02}" in "".join(asked) for i in range(5))


def test_clear_while_a_load_is_logging(env):
    """Nothing is rewritten, so what another load logs meanwhile stays."""
    spec = env.spec("delta_upsert")
    env.run().load(spec, env.frame(*FIRST))
    env.log.open("other", "elsewhere", next_window(None, env.time))
    before = env.log.table.location()
    slow = LoadLog(env.spark, env.root, env.log.table.name, clock=lambda: env.time)
    entries = slow.entries

    def meanwhile(*only):
        found = entries(*only)
        slow.entries = entries
        env.log.complete("other", "elsewhere", "delta", 5, at("2024-05-01"), "dt")
        return found

    slow.entries = meanwhile
    assert slow.clear(spec.name) == 1
    assert env.log.table.location() == before
    assert env.logged() == [] and env.log.last_extraction(spec.name) is None
    assert env.log.last_extraction("elsewhere") == at("2024-05-01")
    env.run().load(spec, env.frame(*SECOND))
    assert env.log.last_extraction(spec.name) == at("2024-02-10")
    assert env.log.clear(spec.name) == 1 and env.log.clear(spec.name) == 0
    env.log.compact()
    assert env.log.table.read().count() == 1


def test_column_histograms_on_request(env):
    spec = env.spec("delta_upsert", analyze="histograms")
    env.run().load(spec, env.frame(*FIRST))
    table = Table(env.spark, spec.name, env.root)
    known = table.column_statistics("v")
    assert (known["min"], known["max"], known["num_nulls"]) == ("10", "30", "0")
    assert any(key.startswith("bin_") for key in known)
    assert table.statistics()[1] == 3


def test_statistics_of_partitions_add_batches_up(env):
    spec = env.spec("delta", partitioning=RANGES)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    table = Table(env.spark, spec.name, env.root)
    assert table.statistics(JAN)[1] == 3 and table.statistics(FEB)[1] == 2


@pytest.mark.parametrize("scope", ["partition", "changed"])
def test_one_row_per_key_takes_no_window_over_both_sides(env, scope):
    spec = env.spec("partitions", partitioning=RANGES, delete_duplicates=True, dedup_scope=scope)
    env.run().load(spec, env.frame(*FIRST))
    plans = []
    original = Table.write

    def write(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return original(self, df, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Table, "write", write)
        env.run().load(spec, env.frame((2, "a", 22, "2024-01-02"), (2, "a", 21, "2024-01-03")))
    assert "Window" not in plans[-1] and "LeftAnti" in plans[-1]
    assert [p for p in env.parts() if p[1] == 2] == [(JAN, 2, 21)]
