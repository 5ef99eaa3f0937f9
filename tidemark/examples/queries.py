"""Every operator as a query over the test tables.

Inputs that the tables lack are derived from whole tables: orders serve as a
ledger target and all order lines as the delta for it (several lines per order,
dates moved by the shipping time, a later last date); events serve as a history
with NULL keys and as a load log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.examples import retail
from tidemark.functions.sqltypes import typed_select
from tidemark.operators import keyed, strategies
from tidemark.operators import profile as profiles
from tidemark.operators.filters import delta_filter, moment
from tidemark.operators.partitioning import (
    DEFAULT,
    PART,
    ExpressionPartitions,
    ListPartitions,
    RangePartitions,
    part_start,
    prune,
    route,
)
from tidemark.operators.partitioning import changed_partitions as changed_partitions_of
from tidemark.plans import loadlog, windows
from tidemark.plans.loadlog import LoadLog
from tidemark.plans.run import LoadRun
from tidemark.plans.spec import Layout, LoadSpec
from tidemark.plans.windows import Window
from tidemark.session import configure
from tidemark.sources.external import SourceSpec, read_source

Query = Callable[[SparkSession, str], DataFrame]

RANGES = RangePartitions.of(
    "dt", ("1996-01-01", "2000-01-01", "1 year"), ("2000-01-01", "2001-01-01", "1 month")
)
MONTHS = ExpressionPartitions.monthly("dt")
ODD_LABELS = ExpressionPartitions(
    "status", "CASE WHEN status IN ('A', 'O') THEN 'a/b' WHEN status IN ('F', 'N') THEN 'x:y %' ELSE '' END"
)
# Above every order key of the test tables.
BEYOND = 1_000_000_000_000
IN_BUCKETS = Layout(distributed_by=("orderkey",), buckets=8)
LEDGER = ["orderkey", "ref", "status", "amount", "dt"]
HISTORY = ["event_id", "ts", "k1", "k2", "value"]


# -- inputs ---------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("ref"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("dt"),
    )


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_partkey").alias("ref"),
        F.col("l_returnflag").alias("status"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("dt"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("k1"),
        F.col("user_id").alias("k2"),
        "value",
    )


def history_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history a month later, for users numbered 50 higher."""
    return history(spark, sf_dir).select(
        "event_id",
        (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        "k1",
        (F.col("k2") + 50).alias("k2"),
        (F.col("value") + 1).alias("value"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("event_id") % 2 == 1
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("entry_id"),
        F.col("event_type").alias("object_name"),
        F.col("user_id").cast("string").alias("invocation_id"),
        (F.col("event_id") % 2 + 1).alias("status"),
        F.col("ts").alias("created_at"),
        F.when(odd & (F.col("event_id") % 17 != 0), F.col("ts")).alias("extraction_to"),
    )


def _spec(strategy: str, **settings) -> LoadSpec:
    base = {"merge_keys": ["orderkey"], "delta_field": "dt"}
    return LoadSpec("ledger", strategy, **{**base, **settings}).validate()


# -- sources -----------------------------------------------------------------------------


def scan_external_full(spark, sf_dir):
    source = SourceSpec(
        "parquet",
        "p_partkey int8, p_name text, p_brand text, p_size int4",
        f"{sf_dir}/part.parquet",
    )
    return read_source(spark, source)


def scan_external_delta(spark, sf_dir):
    source = SourceSpec(
        "parquet",
        "o_orderkey int8, o_custkey int8, o_totalprice float8, o_orderdate timestamp",
        f"{sf_dir}/orders.parquet",
        extraction_type="DELTA",
        delta_field="o_orderdate",
    )
    return read_source(spark, source, Window(datetime(2000, 1, 1), datetime(2001, 1, 1)))


def scan_split_plan(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    seen = profiles.profile_of(orders, "o_orderdate")
    return windows.rows_per_range(orders, "o_orderdate", Window(seen.min_key, seen.max_key))


# -- projections and filters ---------------------------------------------------------------


def typed_projection(spark, sf_dir):
    return typed_select(
        read(spark, sf_dir, "customer"),
        {
            "custkey": ("c_custkey", "int8"),
            "mktsegment": ("c_mktsegment", "varchar(10)"),
            "nationkey": ("c_nationkey", "int4"),
            "name": ("c_name", "bpchar(25)"),
            "acctbal": ("c_acctbal", "numeric(19,4)"),
        },
        pad_char=True,
    )


def typed_lineitem(spark, sf_dir):
    return typed_select(
        read(spark, sf_dir, "lineitem"),
        {
            "shipdate": ("l_shipdate", "date"),
            "orderkey": ("l_orderkey", "int8"),
            "linenumber": ("l_linenumber", "int8"),
            "suppkey": ("l_suppkey", "int4"),
            "discount": ("l_discount", "numeric(19,4)"),
            "quantity": ("l_quantity", "int8"),
            "returnflag": ("l_returnflag", "bpchar(1)"),
        },
    )


def delta_filter_explicit(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "ts", "value")
    return delta_filter(events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))


def delta_filter_auto(spark, sf_dir):
    """The window comes from the log: the last load reached the 25th, and reading
    starts five days before that."""
    model = read(spark, sf_dir, "events").select(
        "event_id", "ts", (F.col("value") * 2).alias("v")
    )
    run, tag = _new_run(spark, datetime(2024, 1, 25))
    spec = LoadSpec(f"{tag}_events", "delta_upsert", ["event_id"], "ts", safety_period="5 days", analyze=False)
    first = F.col("ts") < moment(datetime(2024, 1, 20))
    run.load(spec, model.filter(first).withColumn("v", -F.col("v")))
    run.log.complete(run.invocation_id, spec.name, "init", 0, datetime(2024, 1, 25), "ts")
    run = _next_run(run, datetime(2024, 1, 25))
    run.load(spec, model)
    return run.table(spec.name).read().filter(~first)


def partition_filter(spark, sf_dir):
    routed = route(ledger_orders(spark, sf_dir), RANGES)
    return prune(routed, RANGES, datetime(1999, 6, 15), datetime(2000, 3, 10)).drop(PART)


# -- aggregations and views --------------------------------------------------------------------


def delta_profile(spark, sf_dir):
    return profiles.delta_profile(ledger_lines(spark, sf_dir), "dt")


def table_stats(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("shipdate"), F.col("l_returnflag").alias("returnflag")
    )
    return profiles.table_stats(lines, ["shipdate"], ["returnflag"])


def _sales_inputs(spark, sf_dir, orders=None):
    orders = read(spark, sf_dir, "orders") if orders is None else orders
    orders = orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderdate").alias("orderdate"),
        F.col("o_orderstatus").alias("orderstatus"),
        F.col("o_orderpriority").alias("orderpriority"),
    )
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_quantity").cast("decimal(19,4)").alias("quantity"),
        F.col("l_discount").cast("decimal(19,4)").alias("discount"),
    )
    customer = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name")
    )
    return orders, lines, customer


def _sales(inputs, grain):
    return retail.sales_rows(*inputs, grain)


def sales_view(spark, sf_dir):
    grain = {
        "lineitem": {
            "orderkey": "orderkey",
            "linenumber": "linenumber",
            "partkey": "partkey",
            "suppkey": "suppkey",
            "returnflag": "returnflag",
        },
        "orders": {
            "orderdate": "orderdate",
            "orderstatus": "orderstatus",
            "orderpriority": "orderpriority",
        },
        "customer": {"customer": "name"},
    }
    return _sales(_sales_inputs(spark, sf_dir), grain)


# -- keyed operators -------------------------------------------------------------------------------


def dedup_latest(spark, sf_dir):
    return keyed.latest_per_key(history_delta(spark, sf_dir), ["k1", "k2"], "ts")


# -- strategies on whole tables -----------------------------------------------------------------------


def load_init(spark, sf_dir):
    run, tag = _new_run(spark, datetime(2030, 1, 1))
    spec = LoadSpec(f"{tag}_ledger", "delta_upsert", ["orderkey"], "dt")
    run.load(spec, ledger_orders(spark, sf_dir))
    return run.table(spec.name).read()


def load_full_refresh(spark, sf_dir):
    """All orders in one structure, then in another."""
    run, tag = _new_run(spark, datetime(2030, 1, 1))
    spec = LoadSpec(f"{tag}_orders", "delta_upsert", ["orderkey"], "dt")
    run.load(spec, ledger_orders(spark, sf_dir))
    run = _next_run(run, datetime(2030, 1, 2), full_refresh=True)
    fields = {
        "o_orderkey": ("o_orderkey", "int8"),
        "o_orderstatus": ("o_orderstatus", "text"),
        "totalprice": ("o_totalprice", "numeric(19,4)"),
    }
    renewed = LoadSpec(spec.name, "full")
    run.load(renewed, typed_select(read(spark, sf_dir, "orders"), fields))
    return run.table(spec.name).read()


def load_init_partitioned(spark, sf_dir):
    return ledger_orders(spark, sf_dir).withColumn("part_start", part_start(RANGES))


def _combine(strategy: str, **settings) -> Query:
    def query(spark, sf_dir):
        spec = _spec(strategy, **settings)
        combine = getattr(strategies, strategy)
        return combine(ledger_orders(spark, sf_dir), ledger_lines(spark, sf_dir), spec)

    return query


def _combine_history(strategy: str, **settings) -> Query:
    def query(spark, sf_dir):
        spec = _spec(strategy, **{"merge_keys": ["k1", "k2"], "delta_field": "ts", **settings})
        combine = getattr(strategies, strategy)
        return combine(history(spark, sf_dir), history_delta(spark, sf_dir), spec)

    return query


# -- strategies on partitions ---------------------------------------------------------------------------


def _combine_parts(
    target_of: Query, delta_of: Query, partitioning=RANGES, twice: bool = False, **settings
) -> Query:
    def query(spark, sf_dir):
        spec = _spec("partitions", partitioning=partitioning, **settings)
        delta = delta_of(spark, sf_dir)
        if twice:
            delta = delta.unionByName(delta)
        ends = partitioning
        if isinstance(partitioning, RangePartitions):
            ends = partitioning.open_ended()
        seen = profiles.profile_of(route(delta, ends), "dt", "dt")
        grown = strategies.grow(partitioning, seen)
        target = route(target_of(spark, sf_dir), grown)
        change = strategies.partitions(target, route(delta, grown), spec, seen)
        return strategies.whole(target, change).select(LEDGER)

    return query


def load_delta_append(spark, sf_dir):
    """Plain insertion; the target's partitions grow with the delta."""
    target, delta = ledger_orders(spark, sf_dir), ledger_lines(spark, sf_dir)
    grown = strategies.grow(RANGES, profiles.profile_of(delta, "dt"))
    rows = strategies.append(target, delta, _spec("delta", partitioning=RANGES))
    return rows.withColumn("part_start", part_start(grown))


# -- range partitions ----------------------------------------------------------------------------------------


def changed_partitions(spark, sf_dir):
    return changed_partitions_of(ledger_lines(spark, sf_dir), MONTHS).select(
        F.col(PART).alias("part")
    )


def partition_route(spark, sf_dir):
    routed = ledger_orders(spark, sf_dir).withColumn("part_start", part_start(RANGES))
    return routed.groupBy("part_start").agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("min_key"), F.max("dt").alias("max_key")
    )


def _range_rows(spark, ranges) -> DataFrame:
    rows = [
        (p.name, datetime(p.start.year, p.start.month, p.start.day), datetime(p.end.year, p.end.month, p.end.day))
        for p in ranges
    ]
    schema = "part_name string, part_start timestamp_ntz, part_end timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def partition_plan(spark, sf_dir):
    seen = profiles.profile_of(ledger_lines(spark, sf_dir), "dt")
    return _range_rows(spark, RANGES.extend(seen.max_key)[1])


def partition_overlap(spark, sf_dir):
    seen = profiles.profile_of(ledger_lines(spark, sf_dir), "dt")
    grown = strategies.grow(RANGES, seen)
    found = _range_rows(spark, grown.overlapping(seen.min_key, seen.max_key))
    return found.select("part_start", "part_end")


def partition_split_default(spark, sf_dir):
    routed = route(ledger_orders(spark, sf_dir), RANGES)
    seen = profiles.profile_of(ledger_lines(spark, sf_dir), "dt")
    grown = strategies.grow(RANGES, seen)
    moved = strategies.split_default(routed.filter(F.col(PART) == DEFAULT), grown)
    return (
        moved.withColumn("part_start", part_start(grown))
        .groupBy("part_start")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# -- windows and the load log -----------------------------------------------------------------------------------


def window_adjust(spark, sf_dir):
    at, pick = F.col("o_orderdate"), F.col("o_orderkey") % 5
    lower = upper = None
    for remainder, interval in enumerate(["2 mon", "3 days", "1 year", "5 hours", ""]):
        start, end = windows.adjusted(at, at, interval, "4 days")
        hit = pick == remainder
        lower = F.when(hit, start) if lower is None else lower.when(hit, start)
        upper = F.when(hit, end) if upper is None else upper.when(hit, end)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", lower.alias("extraction_from"), upper.alias("extraction_to")
    )


def next_windows(spark, sf_dir):
    marks = loadlog.last_extractions(event_log(spark, sf_dir))
    return windows.next_windows(marks, datetime(2024, 2, 10), "1 mon", "5 days")


def load_log_last_extraction(spark, sf_dir):
    return loadlog.last_extractions(event_log(spark, sf_dir))


def load_log_complete(spark, sf_dir):
    log = event_log(spark, sf_dir)
    newest = [F.col("created_at").desc(), F.col("entry_id").desc()]
    state = loadlog.current_state(log, ["object_name", "invocation_id"], newest)
    return state.drop("entry_id")


def load_log_clear(spark, sf_dir):
    return loadlog.without_object(event_log(spark, sf_dir), "click", "2024-01-15")


def load_log_verify(spark, sf_dir):
    """Columns a log lacks, with the rows that are without them."""
    log = event_log(spark, sf_dir)
    lacking = F.array([F.lit(name) for name in loadlog.missing_columns(log.columns)])
    return log.agg(F.count(F.lit(1)).alias("row_cnt")).select(
        F.explode(lacking).alias("missing_column"), "row_cnt"
    )


# -- complete runs through tables and log ---------------------------------------------------------------------------


def _new_run(spark: SparkSession, now: datetime) -> tuple[LoadRun, str]:
    configure(spark)
    tag = f"tm_{uuid.uuid4().hex[:12]}"
    # Tables live where the cluster keeps tables, or in a folder set for the library.
    home = spark.conf.get("tidemark.table.root", None) or spark.conf.get("spark.sql.warehouse.dir")
    root = f"{home.rstrip('/')}/{tag}"
    log = LoadLog(spark, root, f"{tag}_log", clock=lambda: now)
    return LoadRun(spark, root, log), tag


def _next_run(run: LoadRun, now: datetime, **settings) -> LoadRun:
    run.log.clock = lambda: now
    return LoadRun(run.spark, run.root, run.log, **settings)


def load_chain_e2e(spark, sf_dir):
    """Orders are loaded as of 2000, then upserted from the window that the log
    yields (with a look-back of 30 days), then summed up as sales."""
    orders = read(spark, sf_dir, "orders")
    run, tag = _new_run(spark, datetime(2001, 1, 1))
    spec = LoadSpec(
        f"{tag}_orders",
        "delta_upsert",
        ["o_orderkey"],
        "o_orderdate",
        partitioning=ExpressionPartitions("o_orderdate", "date_format(o_orderdate, 'yyyy')"),
        safety_period="30 days",
    )
    run.load(spec, orders.filter(F.col("o_orderdate") < moment(datetime(2001, 1, 1))))
    run = _next_run(run, datetime(2030, 1, 1))
    run.load(spec, orders.withColumn("o_orderstatus", F.lower("o_orderstatus")))
    loaded = run.table(spec.name).read()
    grain = {
        "lineitem": {"l_returnflag": "returnflag"},
        "orders": {"o_orderpriority": "orderpriority", "o_orderstatus": "orderstatus"},
        "customer": {},
    }
    return _sales(_sales_inputs(spark, sf_dir, loaded), grain)


def _ledger_runs(spark, sf_dir, strategy: str, times: int = 1, **settings) -> tuple[LoadRun, str]:
    """Load all orders, then all lines by the given strategy."""
    run, tag = _new_run(spark, datetime(2030, 1, 1))
    base = {"partitioning": RANGES, "add_delta": False}
    spec = LoadSpec(f"{tag}_ledger", strategy, ["orderkey"], "dt", **{**base, **settings})
    run.load(spec, ledger_orders(spark, sf_dir))
    for day in range(2, 2 + times):
        run = _next_run(run, datetime(2030, 1, day))
        run.load(spec, ledger_lines(spark, sf_dir))
    return run, spec.name


def _run_ledger(strategy: str, times: int = 1, **settings) -> Query:
    """The table after such loads, with its partition labels."""

    def query(spark, sf_dir):
        run, name = _ledger_runs(spark, sf_dir, strategy, times, **settings)
        return run.table(name).read_parts().withColumnRenamed(PART, "part")

    return query


def _run_flat(strategy: str, backup: bool = False, **settings) -> Query:
    """The same without partitions; with its backup, where that is asked."""

    def query(spark, sf_dir):
        run, name = _ledger_runs(spark, sf_dir, strategy, partitioning=None, **settings)
        table = run.table(name)
        if not backup:
            return table.read()
        now, before = (t.read().withColumn("version", F.lit(v)) for t, v in ((table, "now"), (table.backup(), "before")))
        return now.unionByName(before)

    return query


def load_run_backup_partitioned(spark, sf_dir):
    """The previous version of a partitioned table after a full load."""
    partitioning = ListPartitions("status", ("O", "F"))
    run, name = _ledger_runs(spark, sf_dir, "full", partitioning=partitioning)
    return run.table(name).backup().read_parts().withColumnRenamed(PART, "part")


def load_run_new_keys(spark, sf_dir):
    """All orders, then all lines under keys beyond those of the orders: by the key ranges
    no partition can match, so the lines are added and no order is read again."""
    run, tag = _new_run(spark, datetime(2030, 1, 1))
    spec = LoadSpec(f"{tag}_ledger", "delta_upsert", ["orderkey"], "dt", partitioning=RANGES, add_delta=False)
    run.load(spec, ledger_orders(spark, sf_dir))
    run = _next_run(run, datetime(2030, 1, 2))
    beyond = (F.col("orderkey") + F.lit(BEYOND)).alias("orderkey")
    run.load(spec, ledger_lines(spark, sf_dir).select(beyond, *LEDGER[1:]))
    return run.table(spec.name).read_parts().withColumnRenamed(PART, "part")


def load_run_replicated(spark, sf_dir):
    """Customers and balance by nation, the nations a replicated table."""
    run, tag = _new_run(spark, datetime(2030, 1, 1))
    spec = LoadSpec(f"{tag}_nation", "full", layout=Layout(distribution="replicated"))
    run.load(spec, read(spark, sf_dir, "nation"))
    nations = run.table(spec.name).for_join()
    customers = read(spark, sf_dir, "customer")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("c_acctbal").alias("balance")
    )


def load_run_repeated(spark, sf_dir):
    """All lines are added twice under one invocation, as when a run is repeated, and
    stand in the table once."""
    run, tag = _new_run(spark, datetime(2030, 1, 1))
    spec = LoadSpec(f"{tag}_ledger", "delta", ["orderkey"], "dt", partitioning=RANGES, add_delta=False)
    run.load(spec, ledger_orders(spark, sf_dir))
    for day in (2, 3):
        run = _next_run(run, datetime(2030, 1, day), invocation_id=f"{tag}-lines")
        run.load(spec, ledger_lines(spark, sf_dir))
    return run.table(spec.name).read_parts().withColumnRenamed(PART, "part")


def load_run_open_rows(spark, sf_dir):
    """Orders before 2000, those of status F dated at the end of time, then all orders
    by the window that the log yields: open rows do not keep later ones out."""
    orders = ledger_orders(spark, sf_dir)
    run, tag = _new_run(spark, datetime(2000, 1, 1))
    spec = LoadSpec(f"{tag}_ledger", "delta_upsert", ["orderkey"], "dt")
    end = F.lit("9999-12-31").cast("timestamp_ntz")
    early = orders.filter(F.col("dt") < moment(datetime(2000, 1, 1)))
    run.load(spec, early.withColumn("dt", F.when(F.col("status") == "F", end).otherwise(F.col("dt"))))
    run = _next_run(run, datetime(2030, 1, 1))
    run.load(spec, orders.withColumn("status", F.lower("status")))
    return run.table(spec.name).read()


def _unrouted(strategy: str) -> Query:
    """Orders outside the declared partitions are left out by the initial load, lines
    outside of them by the delta load; counts and rows."""

    def query(spark, sf_dir):
        run, name = _ledger_runs(spark, sf_dir, strategy, unrouted="drop")
        logged = run.log.entries(F.col("object_name") == name)
        counts = logged.agg(F.sum("row_cnt").alias("logged"), F.sum("unrouted").alias("unrouted"))
        rows = run.table(name).read_parts().groupBy(F.col(PART).alias("part")).agg(F.count("*").alias("n"))
        return rows.join(F.broadcast(counts))  # one row

    return query


def load_run_statistics(spark, sf_dir):
    """Rows of each partition after a merge, as the catalog has them."""
    run, name = _ledger_runs(spark, sf_dir, "partitions", partitioning=ODD_LABELS)
    table = run.table(name)
    found = [(label, table.statistics(label)[1]) for label in sorted(table.labels())]
    return spark.createDataFrame(found, "part string, row_cnt long")


def load_run_column_statistics(spark, sf_dir):
    """What the catalog knows of columns after an upsert, histograms included."""
    run, name = _ledger_runs(spark, sf_dir, "delta_upsert", partitioning=None, analyze="histograms")
    table, found = run.table(name), []
    for column in ("orderkey", "ref"):
        known = table.column_statistics(column)
        bins = sum(key.startswith("bin_") for key in known)
        found.append((column, *(int(known[k]) for k in ("min", "max", "num_nulls")), bins > 0))
    return spark.createDataFrame(found, "col string, low long, high long, num_nulls long, histogram boolean")


def load_run_log(spark, sf_dir):
    """What the log says after an initial load, a delta and an empty delta."""
    run, name = _ledger_runs(spark, sf_dir, "partitions")
    run = _next_run(run, datetime(2030, 1, 3))
    spec = LoadSpec(name, "partitions", ["orderkey"], "dt", partitioning=RANGES, add_delta=False)
    run.load(spec, ledger_lines(spark, sf_dir).filter("orderkey IS NULL AND orderkey IS NOT NULL"))
    return run.log.entries(F.col("object_name") == name).select(
        "status", "load_type", "row_cnt", F.coalesce("unrouted", F.lit(0)).alias("unrouted"), "extraction_from", "extraction_to"
    )


QUERIES: dict[str, Query] = {
    "scan_external_full": scan_external_full,
    "scan_external_delta": scan_external_delta,
    "scan_split_plan": scan_split_plan,
    "typed_projection": typed_projection,
    "typed_lineitem": typed_lineitem,
    "delta_filter": delta_filter_explicit,
    "delta_filter_auto": delta_filter_auto,
    "partition_filter": partition_filter,
    "delta_profile": delta_profile,
    "table_stats": table_stats,
    "sales_view": sales_view,
    "dedup_latest": dedup_latest,
    "load_init": load_init,
    "load_full_refresh": load_full_refresh,
    "load_init_partitioned": load_init_partitioned,
    "load_full": _run_flat("full"),
    "load_truncate_insert": _run_flat("truncate_insert"),
    "load_append": _run_flat("append"),
    "load_delete_insert": _combine("delete_insert"),
    "load_delta_append": load_delta_append,
    "load_delta_upsert": _combine("delta_upsert"),
    "load_delta_upsert_dedup": _combine_history("delta_upsert", delete_duplicates=True),
    "load_delta_upsert_null_never_match": _combine_history(
        "delta_upsert", null_keys_match=False
    ),
    "load_delta_merge_rank": _combine_history("delta_merge"),
    "load_delta_merge_rownum": _combine_history("delta_merge", delete_duplicates=True),
    "load_partitions_merge": _combine_parts(ledger_orders, ledger_lines, unrouted="drop"),
    "load_partitions_merge_unrouted": _combine_parts(ledger_orders, ledger_lines),
    "load_partitions_merge_rownum": _combine_parts(
        ledger_lines, ledger_orders, delete_duplicates=True, unrouted="drop"
    ),
    "load_partitions_merge_rownum_unrouted": _combine_parts(
        ledger_lines, ledger_orders, delete_duplicates=True
    ),
    "load_partitions_overwrite_distinct_unrouted": _combine_parts(
        ledger_orders, ledger_lines, twice=True, merge_partitions=False, delete_duplicates=True
    ),
    "load_partitions_overwrite": _combine_parts(
        ledger_orders, ledger_lines, merge_partitions=False, unrouted="drop"
    ),
    "load_partitions_overwrite_unrouted": _combine_parts(
        ledger_orders, ledger_lines, merge_partitions=False
    ),
    "load_partitions_overwrite_distinct": _combine_parts(
        ledger_orders,
        ledger_lines,
        twice=True,
        merge_partitions=False,
        delete_duplicates=True,
        unrouted="drop",
    ),
    "load_partitions_merge_global": _combine_parts(
        ledger_orders, ledger_lines, MONTHS, dedup_scope="changed"
    ),
    "load_partitions_overwrite_months": _combine_parts(
        ledger_orders, ledger_lines, MONTHS, merge_partitions=False
    ),
    "changed_partitions": changed_partitions,
    "partition_route": partition_route,
    "partition_plan": partition_plan,
    "partition_overlap": partition_overlap,
    "partition_split_default": partition_split_default,
    "window_adjust": window_adjust,
    "next_windows": next_windows,
    "load_log_last_extraction": load_log_last_extraction,
    "load_log_complete": load_log_complete,
    "load_log_clear": load_log_clear,
    "load_log_verify": load_log_verify,
    "load_chain_e2e": load_chain_e2e,
    "load_run_partitions_merge": _run_ledger("partitions"),
    "load_run_partitions_overwrite": _run_ledger("partitions", merge_partitions=False),
    "load_run_overwrite_twice": _run_ledger("partitions", 2, merge_partitions=False),
    "load_run_merge_expression": _run_ledger("partitions", partitioning=ODD_LABELS),
    "load_run_merge_across": _run_ledger("partitions", partitioning=ODD_LABELS, dedup_scope="changed"),
    "load_run_full_list": _run_ledger("full", partitioning=ListPartitions("status", ("A", "N"))),
    "load_run_delete_insert": _run_ledger("delete_insert"),
    "load_run_truncate_insert": _run_ledger("truncate_insert"),
    "load_run_log": load_run_log,
    "load_run_upsert_partitioned": _run_ledger("delta_upsert"),
    "load_run_delta_append": _run_ledger("delta"),
    "load_run_upsert_flat": _run_flat("delta_upsert"),
    "load_run_merge_flat": _run_flat("delta_merge", True),
    "load_run_merge_flat_rownum": _run_flat("delta_merge", delete_duplicates=True),
    "load_run_upsert_buckets": _run_flat("delta_upsert", layout=IN_BUCKETS),
    "load_run_merge_buckets": _run_flat("delta_merge", True, layout=IN_BUCKETS),
    "load_run_new_keys": load_run_new_keys,
    "load_run_replicated": load_run_replicated,
    "load_run_full_flat": _run_flat("full", True),
    "load_run_backup_partitioned": load_run_backup_partitioned,
    "load_run_repeated": load_run_repeated,
    "load_run_open_rows": load_run_open_rows,
    "load_run_unrouted": _unrouted("delta_upsert"),
    "load_run_unrouted_delta": _unrouted("delta"),
    "load_run_statistics": load_run_statistics,
    "load_run_column_statistics": load_run_column_statistics,
}
