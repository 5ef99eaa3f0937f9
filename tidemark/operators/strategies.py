"""Load strategies as plain functions of a target and a delta.

Both inputs carry the same columns (see ``sqltypes.align``). Strategies on
partitioned targets return a ``Change``: the labels of the partitions to be
rewritten and their complete new rows, so that untouched partitions are neither
read nor written. Partition-wise inputs carry the label column ``PART``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import keyed
from tidemark.operators.partitioning import (
    DEFAULT,
    PART,
    ExpressionPartitions,
    Partitions,
    RangePartitions,
    in_labels,
    labels_of,
    route,
)
from tidemark.operators.profile import Profile
from tidemark.plans.spec import LoadSpec


@dataclass(frozen=True)
class Change:
    touched: frozenset[str]
    rows: DataFrame


def whole(target: DataFrame, change: Change) -> DataFrame:
    """Complete content of the target after a change."""
    return target.filter(~in_labels(change.touched)).unionByName(change.rows)


# -- strategies on the whole table --------------------------------------------


def full(target: DataFrame, delta: DataFrame, spec: LoadSpec) -> DataFrame:
    """The delta is the new table, also when it is empty."""
    return delta


def append(target: DataFrame, delta: DataFrame, spec: LoadSpec) -> DataFrame:
    return target.unionByName(delta)


def truncate_insert(target: DataFrame, delta: DataFrame, spec: LoadSpec) -> DataFrame:
    return delta


def delete_insert(target: DataFrame, delta: DataFrame, spec: LoadSpec) -> DataFrame:
    """Delete the delta's keys (a NULL key matches nothing), insert the delta."""
    return keyed.replace_matching(target, delta, spec.keys, null_keys_match=False)


def upsert_rows(delta: DataFrame, spec: LoadSpec) -> DataFrame:
    """The rows an upsert inserts."""
    if spec.delete_duplicates:
        return keyed.latest_per_key(delta, spec.keys, spec.delta_field)
    return delta


def delta_upsert(
    target: DataFrame, delta: DataFrame, spec: LoadSpec, delta_key_bytes: int | None = None
) -> DataFrame:
    rows = upsert_rows(delta, spec)
    if by_buckets(spec, delta_key_bytes):
        kept = keyed.without_matches_in_buckets(target, delta, spec.keys, spec.null_keys_match)
        return kept.unionByName(in_buckets(rows, spec))
    kept = keyed.without_matches(target, delta, spec.keys, spec.null_keys_match, delta_key_bytes)
    return kept.unionByName(rows)


def by_buckets(spec: LoadSpec, delta_key_bytes: int | None) -> bool:
    """Is the target compared bucket by bucket? Keys that are broadcast need no more."""
    small = delta_key_bytes is not None and delta_key_bytes <= keyed.BROADCAST_KEY_BYTES
    return spec.keys_in_buckets and not small


def in_buckets(rows: DataFrame, spec: LoadSpec) -> DataFrame:
    return rows.repartition(spec.layout.buckets, *spec.layout.distributed_by)


def delta_merge(
    target: DataFrame, delta: DataFrame, spec: LoadSpec, delta_key_bytes: int | None = None
) -> DataFrame:
    """Delta before target per key: all rows of the winning side, or one row
    per key with ``delete_duplicates``."""
    if spec.delete_duplicates:
        return keyed.first_by_priority(target, delta, spec.keys, spec.delta_field, delta_key_bytes)
    if by_buckets(spec, delta_key_bytes):
        kept = keyed.without_matches_in_buckets(target, delta, spec.keys)
        return kept.unionByName(in_buckets(delta, spec))
    return keyed.replace_matching(target, delta, spec.keys, True, delta_key_bytes)


# -- strategies on partitions ---------------------------------------------------


def merge_within_partitions(
    target: DataFrame, delta: DataFrame, spec: LoadSpec, delta_key_bytes: int | None = None
) -> DataFrame:
    """``delta_merge`` with keys compared only inside one partition."""
    keys = [PART, *spec.keys]
    if spec.delete_duplicates:
        return keyed.first_by_priority(target, delta, keys, spec.delta_field, delta_key_bytes)
    return keyed.replace_matching(target, delta, keys, True, delta_key_bytes)


def merge_across_partitions(
    target: DataFrame, delta: DataFrame, spec: LoadSpec, delta_key_bytes: int | None = None
) -> DataFrame:
    """One row per key over all the given partitions, delta first."""
    return keyed.first_by_priority(target, delta, spec.keys, spec.delta_field, delta_key_bytes)


def grow(spec: Partitions, profile: Profile) -> Partitions:
    """The partitioning after a delta with this key range has arrived."""
    if isinstance(spec, RangePartitions):
        return spec.extend(profile.max_key)[0]
    return spec


def split_default(default_rows: DataFrame, grown: RangePartitions) -> DataFrame:
    """Rows of the default partition, moved to the partitions added since."""
    return route(default_rows.drop(PART), grown)


def partitions(
    target: DataFrame,
    delta: DataFrame,
    spec: LoadSpec,
    profile: Profile,
    delta_key_bytes: int | None = None,
) -> Change:
    """The ``partitions`` strategy; both inputs are labelled with the grown
    partitioning, ``profile`` describes the delta."""
    if isinstance(spec.partitioning, ExpressionPartitions):
        named, stray = profile.parts, False
    else:
        named, stray = profile.parts - {DEFAULT}, DEFAULT in profile.parts
    if stray and spec.unrouted == "error":
        raise ValueError(f"{spec.name}: delta rows outside every partition")
    if stray and spec.unrouted == "drop":
        delta, stray = delta.filter(F.col(PART) != DEFAULT), False

    if not spec.merge_partitions:
        rows = delta.filter(in_labels(named))
        if spec.delete_duplicates:
            rows = rows.dropDuplicates()
        touched = set(named)
        if stray:
            # Nothing bounds the default partition, so it is not overwritten: the
            # delta's rows replace those with the same key, or without keys those
            # equal to them, and the same delta may come again.
            touched.add(DEFAULT)
            own = delta.filter(F.col(PART) == DEFAULT)
            keys = list(spec.merge_keys or comparable_columns(delta))
            if spec.delete_duplicates:
                own = own.dropDuplicates()
            rows = rows.unionByName(
                keyed.replace_matching(target.filter(F.col(PART) == DEFAULT), own, keys)
            )
        return Change(frozenset(touched), rows)

    if spec.dedup_scope == "changed":
        touched = frozenset(named | ({DEFAULT} if stray else set()))
        old = target.filter(in_labels(touched))
        return Change(touched, merge_across_partitions(old, delta, spec, delta_key_bytes))

    touched = set(named)
    if spec.delete_duplicates and getattr(spec.partitioning, "segments", ()):
        # Every partition in the delta's range also loses its own duplicates.
        grown = grow(spec.partitioning, profile)
        touched |= labels_of(grown.overlapping(*profile.key_range()))
    if stray:
        touched.add(DEFAULT)
    old = target.filter(in_labels(touched))
    return Change(frozenset(touched), merge_within_partitions(old, delta, spec, delta_key_bytes))


def comparable_columns(df: DataFrame) -> list[str]:
    """Columns that rows can be compared by."""
    return [f.name for f in df.schema.fields if f.name != PART and "map<" not in f.dataType.simpleString()]


def upsert_partitions(
    target: DataFrame,
    delta: DataFrame,
    spec: LoadSpec,
    profile: Profile,
    delta_key_bytes: int | None = None,
    candidates: frozenset[str] | None = None,
    added: frozenset[str] = frozenset(),
) -> Change:
    """Upsert that rewrites only the partitions with a matching key or a delta
    row. Finding the former reads nothing but the key columns, and only those of the
    ``candidates``, where the partitions that can hold a match are known. Delta rows of
    the partitions ``added`` to, which are none of these, are left to the caller."""
    touched = profile.parts - added
    if candidates is None or candidates:
        keys = target if candidates is None else target.filter(in_labels(candidates))
        hit = keyed.with_matches(
            keys.select(PART, *spec.keys), delta, spec.keys, spec.null_keys_match, delta_key_bytes
        )
        touched |= {row[PART] for row in hit.select(PART).distinct().collect()}
    old = target.filter(in_labels(touched))
    kept = keyed.without_matches(old, delta, spec.keys, spec.null_keys_match, delta_key_bytes)
    rows = upsert_rows(delta.filter(~in_labels(added)) if added else delta, spec)
    return Change(frozenset(touched), kept.unionByName(rows))
