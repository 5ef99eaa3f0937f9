"""Wall time and written bytes of each load strategy, through tables and log.

The target holds all orders, the delta is all order lines; see
``tidemark.examples.queries``.
"""

from __future__ import annotations

import os
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession

from tidemark import LoadSpec, configure
from tidemark.examples import queries as q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

CASES = {
    "full": ("full", {}),
    "append": ("append", {}),
    "delete_insert": ("delete_insert", {}),
    "delta": ("delta", {"partitioning": q.RANGES}),
    "delta_upsert": ("delta_upsert", {}),
    "delta_upsert, partitioned": ("delta_upsert", {"partitioning": q.RANGES}),
    "delta_merge, ties kept": ("delta_merge", {}),
    "delta_merge, one row": ("delta_merge", {"delete_duplicates": True}),
    "partitions, merge": ("partitions", {"partitioning": q.RANGES}),
    "partitions, merge, one row": (
        "partitions",
        {"partitioning": q.RANGES, "delete_duplicates": True},
    ),
    "partitions, overwrite": (
        "partitions",
        {"partitioning": q.RANGES, "merge_partitions": False},
    ),
    "partitions, merge across": (
        "partitions",
        {"partitioning": q.MONTHS, "dedup_scope": "changed"},
    ),
}


def size(root: str) -> int:
    return sum(f.stat().st_size for f in Path(root).rglob("*.parquet"))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        # Small enough that the few megabytes here are written by all cores.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    for warm_up in (True, False):
        for name, (strategy, settings) in CASES.items():
            run, tag = q._new_run(spark, datetime(2030, 1, 1))
            spec = LoadSpec(f"{tag}_t", strategy, ["orderkey"], "dt", add_delta=False, **settings)
            home = run.table(spec.name).home
            started = time.perf_counter()
            run.load(spec, q.ledger_orders(spark, SF_DIR))
            middle, before = time.perf_counter(), size(home)
            q._next_run(run, datetime(2030, 1, 2)).load(spec, q.ledger_lines(spark, SF_DIR))
            ended, after = time.perf_counter(), size(home)
            if not warm_up:
                print(
                    f"| {name} | {middle - started:.2f} | {ended - middle:.2f} "
                    f"| {before / 1e6:.1f} | {(after - before) / 1e6:.1f} |"
                )
    spark.stop()


if __name__ == "__main__":
    main()
