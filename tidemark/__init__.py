"""Incremental loading of large tables with Spark."""

from tidemark.operators.partitioning import (
    ExpressionPartitions,
    ListPartitions,
    RangePartitions,
    Segment,
    Step,
)
from tidemark.plans.loadlog import LoadLog, log_table_name
from tidemark.plans.run import LoadResult, LoadRun
from tidemark.plans.spec import Layout, LoadSpec
from tidemark.session import configure, shared_folder
from tidemark.sinks.table import Table
from tidemark.sources.external import SourceSpec, read_source

__all__ = [
    "ExpressionPartitions",
    "Layout",
    "ListPartitions",
    "LoadLog",
    "LoadResult",
    "LoadRun",
    "LoadSpec",
    "RangePartitions",
    "Segment",
    "SourceSpec",
    "Step",
    "Table",
    "configure",
    "log_table_name",
    "read_source",
    "shared_folder",
]
