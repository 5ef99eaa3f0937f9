"""Mapping of declared SQL column types to Spark types, and typed projections."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# SQL type names and the Spark types they load as.
SIMPLE_TYPES: dict[str, T.DataType] = {
    "int2": T.ShortType(),
    "smallint": T.ShortType(),
    "int4": T.IntegerType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "int32": T.IntegerType(),
    "int8": T.LongType(),
    "bigint": T.LongType(),
    "int64": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float4": T.FloatType(),
    "real": T.FloatType(),
    "float8": T.DoubleType(),
    "double": T.DoubleType(),
    "text": T.StringType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "date32": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}
DEFAULT_DECIMAL = (38, 10)

_TYPE = re.compile(r"^\s*([a-z][a-z0-9_ ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$")
_NULLABLE = re.compile(r"^\s*nullable\s*\((.*)\)\s*$", re.IGNORECASE | re.DOTALL)


class SqlType:
    """One declared type: its Spark type plus a length for character types."""

    def __init__(self, text: str):
        wrapped = _NULLABLE.match(text)
        self.nullable = wrapped is not None
        body = (wrapped.group(1) if wrapped else text).lower()
        match = _TYPE.match(body)
        if not match:
            raise ValueError(f"cannot read SQL type {text!r}")
        name, first, second = match.groups()
        self.length: int | None = None
        self.padded = False
        if name in ("numeric", "decimal"):
            precision, scale = DEFAULT_DECIMAL
            if first is not None:
                precision, scale = int(first), int(second or 0)
            self.spark: T.DataType = T.DecimalType(precision, scale)
        elif name in ("varchar", "character varying"):
            self.spark = T.StringType()
            self.length = int(first) if first else None
        elif name in ("bpchar", "char", "character"):
            self.spark = T.StringType()
            self.length = int(first) if first else 1
            self.padded = True
        elif name in SIMPLE_TYPES and second is None:
            self.spark = SIMPLE_TYPES[name]
        else:
            raise ValueError(f"unknown SQL type {text!r}")

    def cast(self, column: Column, pad_char: bool = False) -> Column:
        """Explicit cast. Character types are cut to their length; blank-padded
        types are stored trimmed unless ``pad_char`` asks for the padding."""
        out = column.cast(self.spark)
        if self.length is not None:
            out = F.substring(out, 1, self.length)
            if self.padded:
                out = F.rpad(out, self.length, " ") if pad_char else F.rtrim(out)
        return out


def parse_fields(ddl: str) -> list[tuple[str, SqlType, bool]]:
    """Read ``"custkey int8 NULL, name varchar(25) NOT NULL"`` into
    ``(name, type, nullable)`` triples."""
    fields = []
    for item in _split_commas(ddl):
        text = item.strip()
        if not text:
            continue
        name, *more = text.split(None, 1)
        rest = more[0].strip() if more else ""
        nullable = True
        if re.search(r"\bnot\s+null$", rest, re.IGNORECASE):
            nullable = False
            rest = re.sub(r"\bnot\s+null$", "", rest, flags=re.IGNORECASE)
        else:
            rest = re.sub(r"\bnull$", "", rest, flags=re.IGNORECASE)
        if not rest.strip():
            raise ValueError(f"field {name!r} has no type")
        fields.append((name.strip('"`'), SqlType(rest), nullable))
    if not fields:
        raise ValueError("no fields declared")
    return fields


def struct_of(ddl: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind.spark, nullable) for name, kind, nullable in parse_fields(ddl)]
    )


def cast_fields(df: DataFrame, ddl: str, pad_char: bool = False) -> DataFrame:
    """Select the declared fields by name, each cast to its declared type."""
    return df.select(
        [kind.cast(F.col(f"`{name}`"), pad_char).alias(name) for name, kind, _ in parse_fields(ddl)]
    )


def typed_select(
    df: DataFrame, columns: Mapping[str, tuple[str | Column, str]], pad_char: bool = False
) -> DataFrame:
    """Rename and cast: ``{"custkey": ("c_custkey", "int8"), ...}``."""
    out = []
    for alias, (source, sql_type) in columns.items():
        column = F.col(source) if isinstance(source, str) else source
        out.append(SqlType(sql_type).cast(column, pad_char).alias(alias))
    return df.select(out)


def align(delta: DataFrame, target: T.StructType) -> DataFrame:
    """Delta columns by name in the target's order and types. A column the
    delta lacks is an error; columns the target lacks are left out."""
    have = {name.lower(): name for name in delta.columns}
    missing = [f.name for f in target.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"delta lacks target columns: {', '.join(missing)}")
    wanted = {f.name.lower() for f in target.fields}
    extra = [name for name in delta.columns if name.lower() not in wanted]
    if extra:
        logger.warning("columns that the target lacks are left out: %s", ", ".join(extra))
    types = {f.name.lower(): f.dataType for f in delta.schema.fields}
    out = []
    for field in target.fields:
        column = F.col(f"`{have[field.name.lower()]}`")
        if types[field.name.lower()] != field.dataType:
            column = column.cast(field.dataType)
        out.append(column.alias(field.name))
    return delta.select(out)


def _split_commas(text: str) -> list[str]:
    parts, depth, current = [], 0, []
    for char in text:
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append("".join(current))
            current = []
        else:
            current.append(char)
    parts.append("".join(current))
    return parts
