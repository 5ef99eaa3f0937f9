"""Delta filters: keep the rows of one extraction window."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moment(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def window_predicate(
    df: DataFrame, column: str, lower: datetime, upper: datetime, lower_exclusive: bool = False
) -> Column:
    """``column BETWEEN lower AND upper`` with the literals brought to the
    column's own type, so that the comparison reaches the file reader."""
    kind = df.schema[column].dataType
    field = F.col(column)
    if isinstance(kind, T.DateType):
        # A date compares as its midnight.
        first = lower.date()
        if lower.time() != time(0) or lower_exclusive:
            first += timedelta(days=1)
        return (field >= F.lit(first)) & (field <= F.lit(upper.date()))
    low, high = moment(lower), moment(upper)
    if isinstance(kind, T.TimestampType):
        low, high = low.cast("timestamp"), high.cast("timestamp")
    return ((field > low) if lower_exclusive else (field >= low)) & (field <= high)


def delta_filter(
    df: DataFrame, column: str, lower: datetime, upper: datetime, lower_exclusive: bool = False
) -> DataFrame:
    return df.filter(window_predicate(df, column, lower, upper, lower_exclusive))
