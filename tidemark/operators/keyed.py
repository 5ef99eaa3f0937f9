"""Key-based combination of a delta with a target.

Notes on skew, which all of these share:

* The keys a delta brings are made distinct first (partial aggregation runs
  before the shuffle), so a key that fills a third of the delta reaches the
  join as one row.
* The anti-join always compares null-safely. Spark then shuffles both sides on
  derived columns, so each join input is a plain shuffle and adaptive execution
  may split a hot key of the target over many tasks. Joining on the bare keys
  would reuse the partitioning of the distinct and lose that.
* One row per key is the maximum of the rows as structures, fields in order of
  priority. That is an aggregation: each task sorts by the keys alone and sends one
  row per key, and nothing compares whole rows but those of one key.
* One row per key of two inputs takes two steps: target rows whose key the delta has
  go first (an anti-join on keys), then each side is aggregated alone. What the target
  keeps never meets the delta.
* "Delta wins, ties kept" is the same set of rows as ``delta`` plus the target
  rows whose key the delta lacks, so it needs no window and no sort by group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest size of raw key bytes that is sent to every executor.
BROADCAST_KEY_BYTES = 32 * 1024 * 1024

_PICK = "__pick"


def key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """Aggregate giving an upper bound on the size of the keys of ``df``."""
    total: Column = F.lit(0).cast("long")
    for name in keys:
        kind = df.schema[name].dataType
        size = F.octet_length(F.col(name)) if isinstance(kind, (T.StringType, T.BinaryType)) else F.lit(16)
        total = total + F.coalesce(size, F.lit(0)) + F.lit(8)
    return F.sum(total)


def _join_on_keys(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    how: str,
    null_keys_match: bool,
    delta_key_bytes: int | None,
) -> DataFrame:
    found = delta.select(*keys)
    if not null_keys_match:
        found = found.dropna(how="any")
    found = found.distinct().select([F.col(k).alias(f"__d_{i}") for i, k in enumerate(keys)])
    if delta_key_bytes is not None and delta_key_bytes <= BROADCAST_KEY_BYTES:
        found = F.broadcast(found)
    pairs = [F.col(name).eqNullSafe(F.col(f"__d_{i}")) for i, name in enumerate(keys)]
    return target.join(found, reduce(Column.__and__, pairs), how)


def without_matches(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    null_keys_match: bool = True,
    delta_key_bytes: int | None = None,
) -> DataFrame:
    """Target rows whose key does not occur in the delta.

    ``null_keys_match=False`` lets a key with a NULL match nothing. The delta's
    keys are broadcast only when their measured size is given and small.
    """
    return _join_on_keys(target, delta, keys, "left_anti", null_keys_match, delta_key_bytes)


def without_matches_in_buckets(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], null_keys_match: bool = True
) -> DataFrame:
    """``without_matches`` for a target that lies in buckets by these keys. Plain
    equality lets Spark use them: the target is read bucket by bucket and only the
    delta's keys are shuffled. Rows with a NULL in a key are compared by themselves."""
    whole = reduce(Column.__and__, [F.col(name).isNotNull() for name in keys])
    found = delta.filter(whole).select(*keys).distinct()
    kept = target.filter(whole).join(found, list(keys), "left_anti").select(*target.columns)
    rest = target.filter(~whole)
    if null_keys_match:
        rest = without_matches(rest, delta.filter(~whole), keys)
    return kept.unionByName(rest)


def with_matches(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    null_keys_match: bool = True,
    delta_key_bytes: int | None = None,
) -> DataFrame:
    """Target rows whose key occurs in the delta."""
    return _join_on_keys(target, delta, keys, "left_semi", null_keys_match, delta_key_bytes)


def replace_matching(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    null_keys_match: bool = True,
    delta_key_bytes: int | None = None,
) -> DataFrame:
    """All delta rows, and the target rows of keys the delta lacks."""
    kept = without_matches(target, delta, keys, null_keys_match, delta_key_bytes)
    return kept.unionByName(delta)


def _sortable(df: DataFrame, name: str) -> Column:
    """A column, or what stands for it where Spark has no order for its type."""
    kind = df.schema[name].dataType
    if "map<" not in kind.simpleString():
        return F.col(name)
    if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString():
        return F.array_sort(F.map_entries(name))
    return F.to_json(F.struct(name))  # maps inside other types


def latest_order(df: DataFrame, keys: Sequence[str], delta_field: str | None) -> list[str]:
    """The columns that decide within a key, newest first, NULLs before values: a
    total order, so that a recomputed task picks the same row again. Keys come last;
    they only differ where Spark takes different values for equal (-0.0 and 0.0)."""
    first = [delta_field] if delta_field else []
    names = [f.name for f in df.schema.fields]
    return [*first, *(n for n in names if n not in keys and n not in first), *(n for n in names if n in keys and n not in first)]


def latest_per_key(df: DataFrame, keys: Sequence[str], delta_field: str | None = None) -> DataFrame:
    """One row per key, the newest by ``delta_field``."""
    order = latest_order(df, keys, delta_field)
    fields: list[Column] = []
    for i, name in enumerate(order):
        fields += [F.col(name).isNull().alias(f"n{i}"), _sortable(df, name).alias(f"v{i}")]
    places = {name: f"v{i}" for i, name in enumerate(order)}
    if any("map<" in f.dataType.simpleString() for f in df.schema.fields):
        best = F.max_by(F.struct(*[F.col(n).alias(f"v{i}") for i, n in enumerate(order)]), F.struct(*fields))
    else:
        best = F.max(F.struct(*fields))
    grouped = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(best.alias(_PICK))
    return grouped.select(*[F.col(f"{_PICK}.{places[c]}").alias(c) for c in df.columns])


def first_by_priority(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    delta_field: str | None = None,
    delta_key_bytes: int | None = None,
) -> DataFrame:
    """One row per key over both inputs, delta rows before target rows."""
    kept = without_matches(target, delta, keys, True, delta_key_bytes)
    return latest_per_key(kept, keys, delta_field).unionByName(latest_per_key(delta, keys, delta_field))
