"""Buckets, random and replicated tables: plans, and rows after each load."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_loads import FIRST, JAN, RANGES, SECOND, env  # noqa: F401

from tidemark import Layout
from tidemark.operators import keyed
from tidemark.sinks import table as tables
from tidemark.sinks.table import Table

BUCKETS = Layout(distributed_by=("id",), buckets=4)


def table(env):
    return Table(env.spark, env.name(), env.root)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(env, monkeypatch):
    """The plans of what is written, with keys never broadcast."""
    monkeypatch.setattr(keyed, "BROADCAST_KEY_BYTES", -1)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        env.spark.conf.set(key, "-1")
    plans, original = [], Table.write

    def write(self, df, version, layout, *args, **kwargs):
        plans.append(plan_of(tables.arrange(df, layout, kwargs.get("cluster", True))))
        return original(self, df, version, layout, *args, **kwargs)

    monkeypatch.setattr(Table, "write", write)
    yield plans
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        env.spark.conf.unset(key)


def under(plan, leaf):
    """The operators above the first line that has a text, nearest first."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    found, last = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < last:
            found.append(line)
            last = depth(line)
    return found


@pytest.mark.parametrize("strategy", ["delta_upsert", "delta_merge", "delete_insert"])
def test_merge_by_buckets_does_not_shuffle_the_target(env, written, strategy):
    spec = env.spec(strategy, layout=BUCKETS)
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame(*SECOND))
    assert env.rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]
    merge = written[-1]
    # The scan of rows with whole keys: bucketed, and no exchange up to the writer.
    assert "Bucketed: true" in merge and "SelectedBucketsCount: 4 out of 4" in merge
    assert not any("Exchange" in line for line in under(merge, "Bucketed: true"))


def test_buckets_stay_through_loads_without_a_layout(env, written):
    env.run().load(env.spec("delta_upsert", layout=BUCKETS), env.frame(*FIRST, *[(i, "x", i, JAN) for i in range(10, 40)]))
    env.run().load(env.spec("delta_upsert"), env.frame(*SECOND))
    env.run().load(env.spec("full"), env.frame(*FIRST, *SECOND))
    files = {Path(f).name.split("_")[-1][:5] for f in table(env).read().inputFiles()}
    assert files <= {f"{i:05}" for i in range(4)} and len(files) > 1
    assert env.rows(table(env).backup())[:4] == [(1, 10), (2, 21), (3, 30), (4, 40)]
    joined = table(env).read().join(table(env).read().withColumnRenamed("v", "w"), "id")
    assert plan_of(joined).count("Bucketed: true") == 2 and "Exchange" not in plan_of(joined)
    # A refresh without buckets is another structure.
    env.run(full_refresh=True).load(env.spec("delta_upsert"), env.frame(*FIRST))
    assert table(env).following(Layout()).buckets == 0
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]


@pytest.mark.parametrize("match", [True, False])
def test_null_keys_in_buckets(env, written, match):
    spec = env.spec("delta_upsert", layout=BUCKETS, null_keys_match=match)
    env.run().load(spec, env.frame((None, "a", 1, JAN), (1, "a", 2, JAN)))
    env.run().load(spec, env.frame((None, "a", 3, JAN), (1, "a", 4, JAN)))
    found = sorted(((r.id or 0), r.v) for r in table(env).read().collect())
    assert found == ([(0, 3), (1, 4)] if match else [(0, 1), (0, 3), (1, 4)])


@pytest.mark.parametrize("strategy", ["delta_upsert", "delta_merge", "delete_insert", "truncate_insert"])
def test_small_deltas_and_one_row_per_key_in_buckets(env, strategy):
    spec = env.spec(strategy, layout=BUCKETS, delete_duplicates=strategy == "delta_merge")
    env.run().load(spec, env.frame(*FIRST))
    env.run().load(spec, env.frame((9, "n", 90, JAN)))
    env.run().load(spec, env.frame(*SECOND))
    left = [(2, 21), (4, 40)]
    assert env.rows() == (left if strategy == "truncate_insert" else [(1, 10), (2, 21), (3, 30), (4, 40), (9, 90)])
    assert all("_0000" in f for f in table(env).read().inputFiles())


def test_replicated_tables_are_sent_if_they_are_small(env, monkeypatch):
    env.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spec = env.spec("full", layout=Layout(distribution="replicated"))
        env.run().load(spec, env.frame(*FIRST))
        env.run().load(env.spec("full"), env.frame(*FIRST, *SECOND))
        facts = env.spark.range(10)
        join = lambda: plan_of(facts.join(table(env).for_join(), "id"))
        assert "BroadcastHashJoin" in join()
        assert "BroadcastHashJoin" not in plan_of(facts.join(table(env).read(), "id"))
        monkeypatch.setattr(tables, "REPLICATED_MEMORY", 100)
        assert "Broadcast" not in join()
        monkeypatch.setattr(tables, "REPLICATED_MEMORY", 1 << 28)
        monkeypatch.setattr(tables, "REPLICATED_BYTES", 100)
        assert "Broadcast" not in join()
        monkeypatch.setattr(tables, "REPLICATED_BYTES", 1 << 20)
        env.run().load(env.spec("full", analyze=False), env.frame(*FIRST))
        assert "Broadcast" not in join()
    finally:
        env.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_random_distribution_deals_rows_out(env):
    spec = env.spec("full", layout=Layout(distribution="random"))
    df = tables.arrange(env.frame(*FIRST).withColumn("x", F.lit(1)), spec.layout)
    assert "RoundRobinPartitioning" in plan_of(df)
    env.run().load(spec, env.frame(*FIRST))
    assert env.rows() == [(1, 10), (2, 20), (3, 30)]


@pytest.mark.parametrize(
    "layout, settings",
    [
        (Layout(buckets=4), {}),
        (Layout(distribution="odd"), {}),
        (Layout(distributed_by=("id",), distribution="random"), {}),
        (BUCKETS, {"partitioning": RANGES}),
    ],
)
def test_layouts_that_cannot_be(env, layout, settings):
    with pytest.raises(ValueError):
        env.spec("delta_upsert", layout=layout, **settings).validate()
