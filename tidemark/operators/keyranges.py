"""Ranges of key values, by which partitions are passed over unread.

A range holds the lowest and the highest image of a key column, and whether there
are NULLs. The image of a value is a number or a short text that equal values share,
so ranges that do not meet prove that no keys are equal; it need not be the value
itself (a text counts by its first characters). Floating-point and nested keys have
no range, which means that they may match anything.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.partitioning import PART

# Characters of a text that its image is made from.
PREFIX = 32

#: Lowest image, highest image, whether NULL occurs; by key column.
Ranges = dict[str, tuple]


def image(df: DataFrame, name: str) -> Column | None:
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, T.DecimalType):
        return F.floor(column).cast("decimal(38,0)")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return column.cast("string")
    if kind == T.StringType():
        # Hexadecimal digits are in the order of the bytes, in every language.
        return F.hex(F.substring(column, 1, PREFIX))
    return None


def range_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Aggregates behind the ranges of some key columns."""
    out = []
    for i, name in enumerate(keys):
        value = image(df, name)
        if value is not None:
            out += [F.min(value).alias(f"low_{i}"), F.max(value).alias(f"high_{i}")]
            out.append(F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"))
    return out


def ranges_of(values: Mapping, keys: Sequence[str]) -> Ranges:
    """Ranges from the values of those aggregates."""

    def plain(value):
        return value if value is None or isinstance(value, str) else int(value)

    return {
        name: (plain(values[f"low_{i}"]), plain(values[f"high_{i}"]), bool(values[f"nulls_{i}"]))
        for i, name in enumerate(keys)
        if f"nulls_{i}" in values
    }


def ranges_by_partition(df: DataFrame, keys: Sequence[str]) -> dict[str, Ranges]:
    """The ranges of each partition: a scan of the key columns, one row back for each."""
    columns = range_columns(df, keys)
    if not columns:
        return {}
    rows = df.groupBy(PART).agg(*columns).collect()
    return {row[PART]: ranges_of(row.asDict(), keys) for row in rows}


def may_match(one: Ranges, other: Ranges, null_keys_match: bool = True) -> bool:
    """Can two sets of rows share a key? Every key column has to agree."""
    for name in one.keys() & other.keys():
        low, high, nulls = one[name]
        other_low, other_high, other_nulls = other[name]
        values = None not in (low, other_low) and low <= other_high and other_low <= high
        if not values and not (null_keys_match and nulls and other_nulls):
            return False
    return True


def to_text(ranges: Ranges) -> str:
    """In hexadecimal digits, as Spark blots out properties that mention a url or token."""
    return json.dumps(ranges).encode().hex()


def from_text(text: str) -> Ranges:
    return {name: tuple(bounds) for name, bounds in json.loads(bytes.fromhex(text)).items()}
