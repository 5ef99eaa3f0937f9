"""Scalar facts about a delta or a table, each taken in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import NTZ, to_datetime
from tidemark.operators.keyed import key_bytes
from tidemark.operators.keyranges import Ranges, range_columns, ranges_of
from tidemark.operators.partitioning import DEFAULT, END_OF_TIME, PART


@dataclass(frozen=True)
class Profile:
    """Row count, range of the partition key, new high-water mark, partitions, size and
    ranges of the merge keys."""

    row_cnt: int = 0
    min_key: datetime | None = None
    max_key: datetime | None = None
    max_delta: datetime | None = None
    parts: frozenset[str] = frozenset()
    key_bytes: int | None = None
    unrouted: int = 0
    key_ranges: Ranges = field(default_factory=dict)

    @classmethod
    def of_metrics(cls, values: dict, keys: Sequence[str] = ()) -> Profile:
        return cls(
            row_cnt=values.get("row_cnt") or 0,
            min_key=values.get("min_key"),
            max_key=values.get("max_key"),
            max_delta=values.get("max_delta"),
            parts=frozenset(values.get("parts") or ()),
            key_bytes=values.get("key_bytes"),
            unrouted=values.get("unrouted") or 0,
            key_ranges=ranges_of(values, keys),
        )

    def key_range(self) -> tuple[datetime | None, datetime | None]:
        return to_datetime(self.min_key), to_datetime(self.max_key)


def _wall_clock(df: DataFrame, name: str) -> Column:
    """Zoned timestamps in the session's zone, so that the driver's own zone
    plays no part."""
    column = F.col(name)
    return column.cast(NTZ) if isinstance(df.schema[name].dataType, T.TimestampType) else column


def _before_the_end(df: DataFrame, name: str) -> Column:
    """Open rows are marked by the end of time. It is no key to grow to, and no mark
    to read on from: nothing would ever come after it."""
    column = _wall_clock(df, name)
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        column = F.when(column < F.lit(END_OF_TIME), column)
    return column


def profile_columns(
    df: DataFrame,
    partition_key: str | None = None,
    delta_field: str | None = None,
    keys: Sequence[str] = (),
) -> list[Column]:
    """Aggregates behind a ``Profile``; the number of distinct labels is the
    number of partitions, which the driver handles anyway."""
    out = [F.count(F.lit(1)).alias("row_cnt")]
    if partition_key:
        key = _before_the_end(df, partition_key)
        out += [F.min(key).alias("min_key"), F.max(key).alias("max_key")]
    if delta_field:
        out.append(F.max(_before_the_end(df, delta_field)).alias("max_delta"))
    if PART in df.columns:
        out.append(F.collect_set(PART).alias("parts"))
        out.append(F.count_if(F.col(PART) == DEFAULT).alias("unrouted"))
    if keys:
        out.append(key_bytes(df, keys).alias("key_bytes"))
        out += range_columns(df, keys)
    return out


def delta_profile(df: DataFrame, partition_key: str) -> DataFrame:
    return df.agg(*profile_columns(df, partition_key))


def profile_of(
    df: DataFrame,
    partition_key: str | None = None,
    delta_field: str | None = None,
    keys: Sequence[str] = (),
) -> Profile:
    row = df.agg(*profile_columns(df, partition_key, delta_field, keys)).first()
    return Profile.of_metrics(row.asDict(), keys)


def table_stats(df: DataFrame, columns: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """Row count, per column minimum and maximum, and exact distinct counts."""
    out = [F.count(F.lit(1)).alias("row_count")]
    for name in columns:
        out += [F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}")]
    out += [F.count_distinct(name).alias(f"ndv_{name}") for name in distinct]
    return df.agg(*out)
