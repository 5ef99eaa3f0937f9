"""What a user declares about one load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.functions.sqltypes import parse_fields
from tidemark.operators.partitioning import Partitions

# Strategies that gate on an empty delta and keep a high-water mark.
TRACKED = ("full", "delta", "delta_upsert", "delta_merge", "partitions")
# Plain strategies without a log entry.
PLAIN = ("append", "truncate_insert", "delete_insert")
DEFAULT_KEYS = ("id",)

Hook = Callable[[SparkSession], object]


@dataclass(frozen=True)
class Layout:
    """Physical layout of the written files.

    With ``buckets`` rows lie in that many buckets by the hash of ``distributed_by``,
    known to the catalog: joins and merges on these columns do not shuffle the table.
    All rows of one key are in one bucket, so this is for keys that repeat little.
    ``distribution`` is ``"random"`` (rows dealt out evenly) or ``"replicated"`` (a
    small table, sent to every executor by ``Table.for_join``, if it is small).
    An existing table keeps its buckets and distribution until it is refreshed in full.
    """

    distributed_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    compression: str = "zstd"
    compression_level: int | None = None
    buckets: int = 0
    distribution: str = ""


@dataclass(frozen=True)
class LoadSpec:
    name: str
    strategy: str
    merge_keys: Sequence[str] = ()
    delta_field: str | None = None
    partitioning: Partitions | None = None
    fields: str | None = None
    safety_period: str = "0 days"
    load_interval: str = ""
    add_delta: bool = True
    delete_duplicates: bool = False
    merge_partitions: bool = True
    # "partition": keys compare inside one partition; "changed": keys compare
    # over all partitions the delta touches, one row per key survives.
    dedup_scope: str = "partition"
    null_keys_match: bool = True
    # What to do with delta rows that no named partition covers.
    unrouted: str = "default"
    lower_exclusive: bool = False
    keep_backup: bool = True
    # True: size and row count; "columns": a scan for column statistics as
    # well; "histograms": these with histograms; False: nothing.
    analyze: bool | str = True
    layout: Layout = field(default_factory=Layout)
    pre_hooks: Sequence[Hook] = ()
    post_hooks: Sequence[Hook] = ()

    @property
    def keys(self) -> list[str]:
        return list(self.merge_keys or DEFAULT_KEYS)

    @property
    def keys_in_buckets(self) -> bool:
        """Are rows with equal keys in the same bucket?"""
        return self.layout.buckets > 0 and set(self.layout.distributed_by) == set(self.keys)

    def validate(self) -> LoadSpec:
        """Raise ``ValueError`` for a spec that cannot run."""
        if self.strategy not in TRACKED + PLAIN:
            raise ValueError(f"{self.name}: unknown strategy {self.strategy!r}")
        if self.strategy in ("delta_upsert", "delta_merge", "delete_insert") and not self.merge_keys:
            raise ValueError(f"{self.name}: strategy {self.strategy!r} needs merge_keys")
        if self.strategy in TRACKED and self.strategy != "full" and not self.delta_field:
            raise ValueError(f"{self.name}: strategy {self.strategy!r} needs a delta_field")
        if self.strategy in ("delta", "partitions") and self.partitioning is None:
            raise ValueError(f"{self.name}: strategy {self.strategy!r} needs a partitioning")
        if self.dedup_scope not in ("partition", "changed"):
            raise ValueError(f"{self.name}: unknown dedup_scope {self.dedup_scope!r}")
        if self.unrouted not in ("default", "drop", "error"):
            raise ValueError(f"{self.name}: unknown value {self.unrouted!r} for unrouted")
        layout = self.layout
        if layout.distribution not in ("", "random", "replicated"):
            raise ValueError(f"{self.name}: unknown distribution {layout.distribution!r}")
        if layout.distribution and layout.distributed_by:
            raise ValueError(f"{self.name}: a {layout.distribution} table is not distributed by columns")
        if layout.buckets < 0 or layout.buckets and not layout.distributed_by:
            raise ValueError(f"{self.name}: buckets need distributed_by")
        if layout.buckets and (self.partitioning is not None or self.strategy == "append"):
            raise ValueError(f"{self.name}: buckets are for tables without partitions or batches")
        if self.fields is not None:
            parse_fields(self.fields)
        return self
